"""Command line: clean, train, evaluate, compare and tokenize."""

from __future__ import annotations

import argparse
import json
import os

from .functions import values as V
from .operators import tokens
from .plans import pipeline as P
from .session import session
from .sources import readers, sinks


def _pairs(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(x.split(":", 1)) for x in text.split(",") if x)


def clean(a: argparse.Namespace) -> None:
    known = set(P.DEFAULTS)
    config = {k: v for k, v in P.load_config(P.read_config(a.cleaning_config) if a.cleaning_config else None, P.read_config(a.config) if a.config else None).items() if k in known}
    config |= {"near_dedup": True} if a.near_dedup else {}
    n = sinks.clean_jsonl(
        session(), a.input, a.output, category=a.category, dataset=a.dataset, stage=a.stage, config=config, manifest_path=a.manifest, summary_path=a.summary, keep_dropped=a.keep_dropped,
        id_field=a.id_field, text_fields=tuple(a.text_fields.split(",")), field_map=_pairs(a.field_map),
    )
    print(f"{n} records written to {a.output}")


def train(a: argparse.Namespace) -> None:
    c = tokens.named_config(P.read_config(a.configs)["tokenizers"], a.name) if a.configs else {}
    t = tokens.train(readers.read_corpus(session(), a.corpus, a.text_field), model_type=c.get("model", a.model), vocab_size=int(c.get("vocab_size", a.vocab_size)), special_tokens=c.get("special_tokens", V.SPECIAL_TOKENS), max_samples=a.max_samples)
    tokens.save(t, a.output)
    print(f"{t.get_vocab_size()} entries written to {a.output}")


def evaluate(a: argparse.Namespace) -> None:
    texts = readers.read_corpus(session(), a.corpus, a.text_field)
    for path in a.tokenizer:
        rows = tokens.compression(texts, tokens.load(path), max_samples=a.max_samples).collect()
        report = json.loads(json.dumps(rows[0].asDict(recursive=True))) if rows else {"error": "no tokens produced"}
        print(json.dumps({"tokenizer": path} | report, ensure_ascii=False))
        if a.report:
            sinks.write_json(report, os.path.join(a.report, os.path.basename(os.path.normpath(path)) + ".json"))


def tokenize(a: argparse.Namespace) -> None:
    spark = session()
    t = tokens.load(a.tokenizer)
    rows = tokens.tokenize_files(spark, t, a.corpus, a.text_field, a.max_files, a.max_tokens)
    rows.drop("file").write.mode("overwrite").parquet(a.output)
    total = tokens.totals(spark.read.parquet(a.output)).first()
    if not total.records:
        raise SystemExit(f"no record with a text in {a.corpus}")
    sinks.write_json({"tokenizer": a.tokenizer, "records": total.records, "tokens": total.tokens}, a.meta or "tokens_meta.json")
    print(f"{total.records} records, {total.tokens} tokens")


def main() -> None:
    top = argparse.ArgumentParser(prog="siltworks")
    sub = top.add_subparsers(required=True)
    c = sub.add_parser("clean")
    for name in ("--input", "--output", "--category", "--dataset"):
        c.add_argument(name, required=True)
    for name, value in (("--stage", "pretrain"), ("--id-field", "id"), ("--text-fields", "text"), ("--field-map", ""), ("--config", None), ("--cleaning-config", None), ("--manifest", None), ("--summary", None)):
        c.add_argument(name, default=value)
    c.add_argument("--keep-dropped", action="store_true")
    c.add_argument("--near-dedup", action="store_true")
    c.set_defaults(run=clean)
    t = sub.add_parser("train-tokenizer")
    t.add_argument("--corpus", nargs="+", required=True)
    t.add_argument("--output", required=True)
    for name, value in (("--model", "bpe"), ("--configs", None), ("--name", None), ("--text-field", "text")):
        t.add_argument(name, default=value)
    t.add_argument("--vocab-size", type=int, default=65536)
    t.add_argument("--max-samples", type=int, default=0)
    t.set_defaults(run=train)
    e = sub.add_parser("evaluate-tokenizer", aliases=["compare-tokenizers"])
    e.add_argument("--corpus", nargs="+", required=True)
    e.add_argument("--tokenizer", nargs="+", required=True)
    e.add_argument("--max-samples", type=int, default=10000)
    e.add_argument("--text-field", default="text")
    e.add_argument("--report")
    e.set_defaults(run=evaluate)
    k = sub.add_parser("tokenize")
    k.add_argument("--corpus", nargs="+", required=True)
    for name in ("--tokenizer", "--output"):
        k.add_argument(name, required=True)
    k.add_argument("--text-field", default="text")
    k.add_argument("--max-files", type=int, default=0)
    k.add_argument("--max-tokens", type=int, default=0)
    k.add_argument("--meta")
    k.set_defaults(run=tokenize)
    a = top.parse_args()
    a.run(a)


if __name__ == "__main__":
    main()
