"""Reference cases of the cleaning rules, on hand-made rows."""

import gzip
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.functions import hashing as H
from siltworks.functions import text as X
from siltworks.functions import values as V
from siltworks.operators import dedup, mixture, packing, tokens
from siltworks.plans import pipeline as P
from siltworks.plans import presets as R
from siltworks.session import ship
from siltworks.sources import catalog, readers, sinks


@pytest.fixture(autouse=True)
def _ship(spark):
    ship(spark)


def run(spark, category, rows, schema, config=None, **kw):
    df = spark.createDataFrame(rows, schema)
    out = P.build_pipeline(category, config).run(df, "set", seq="seq_in", keep_dropped=True, **kw)
    return {r.seq: r for r in out.collect()}


def js(spark, category, records, config=None, **kw):
    """Run records as VARIANT, as strict JSONL gives them."""
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "seq_in bigint, j string").select("seq_in", F.parse_json("j").alias("data"))
    out = P.build_pipeline(category, config).run(df, "set", seq="seq_in", keep_dropped=True, **kw)
    return [r for _, r in sorted((r.seq, r) for r in out.collect())]


# --- text -------------------------------------------------------------------


def test_clean():
    assert X.clean("a\r\nb\rc") == "a\nb\nc"
    assert X.clean("a   b\t c ") == "a b c"
    assert X.clean("a\n\n\n\nb") == "a\n\nb"
    assert X.clean("Ａ\x00b c\x7f") == "Ab c"


def test_lines_like_splitlines(spark):
    cases = ["", "a", "a\n", "a\r\nb", "a\n\nb\n\n", "a b\x0bc\x1cd\x85e", "\n"]
    got = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, c string").select("k", X.lines(F.col("c")).alias("l")).collect()
    assert {r.k: list(r.l) for r in got} == {k: c.splitlines() for k, c in enumerate(cases)}


def test_simhash_orders_by_similarity():
    a, b, c = (H.fingerprint(t) for t in ("the quick brown fox jumps over the lazy dog today", "the quick brown fox jumps over the lazy dog tonight", "completely different words about something else entirely here"))
    d = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    assert d(a, b) < d(a, c)
    assert H.fingerprint("!!! ???") == 0


def test_simhash_against_plain_votes():
    import hashlib

    def plain(text, n=5):
        t = re.findall(r"\w+", text.casefold())
        if not t:
            return 0
        w = [0] * 64
        for i in range(max(1, len(t) - n + 1)):
            x = int.from_bytes(hashlib.blake2b(" ".join(t[i : i + n]).encode(), digest_size=8).digest(), "big")
            for b in range(64):
                w[b] += 1 if x >> b & 1 else -1
        return sum(1 << b for b in range(64) if w[b] >= 0)

    r = random.Random(3)
    for _ in range(30):
        text = " ".join(r.choice("ab cd ef Straße x1 y_2".split()) for _ in range(r.randint(0, 40)))
        assert H.fingerprint(text) & (2**64 - 1) == plain(text)


def test_near_duplicates_equal_the_sequential_rule(spark):
    r = random.Random(5)
    prints = [0, 7, 63, 63, -1]
    for _ in range(200):
        x = r.choice(prints)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randint(0, 62)
        prints.append(x)
    want = {k for k, x in enumerate(prints) if any(((x ^ y) & (2**64 - 1)).bit_count() <= 3 for y in prints[:k])}
    got = dedup.near_duplicates(spark.createDataFrame(list(enumerate(prints)), "seq bigint, fp bigint"))
    assert {x.seq for x in got.collect()} == want
    with pytest.raises(ValueError):
        dedup.near_duplicates(spark.createDataFrame([(1, 1)], "seq bigint, fp bigint"), 4, 4)


def test_buckets(spark):
    rows = [100, 4096, 4097, 5000, 20000, 70000]
    got = [r.b for r in spark.createDataFrame([(x,) for x in rows], "n int").select(X.context_bucket(F.col("n")).alias("b")).collect()]
    assert got == ["B4K", "B4K", "B16K", "B16K", "B64K", "gt_64K"]
    assert spark.range(1).select(X.context_bucket(F.lit(5), [10]).alias("b")).first().b == "B0K"
    with pytest.raises(ValueError):
        X.context_bucket(F.lit(1), [0, -4])


def test_loss_mask(spark):
    assert spark.range(1).select(X.loss_mask(F.array(*map(F.lit, [1, 2, -100, 4, -100]))).alias("m")).first().m == [1, 1, 0, 1, 0]


# --- pipelines --------------------------------------------------------------


def test_smoke_case(spark, tmp_path):
    rows = [
        {"id": "doc1", "text": "This is a good enough document text.", "source": "s", "quality_mean": 4.5}, {"id": "doc2", "text": "short", "source": "s", "quality_mean": 4.5},
        {"id": "doc3", "text": "This is a good  enough document TEXT.", "source": "s", "quality_mean": 4.5}, {"id": "doc4", "text": "Another document of low quality here.", "source": "s", "quality_mean": 2.0},
    ]
    path = tmp_path / "in.jsonl.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n\n".join(map(json.dumps, rows)) + "\n")
    n = sinks.clean_jsonl(spark, str(path), str(tmp_path / "out"), category="web", dataset="x", config={"quality_policies": V.QUALITY_POLICIES, "near_dedup": True}, manifest_path=str(tmp_path / "m.json"))
    assert n == 1
    assert json.loads((tmp_path / "m.json").read_text())["decisions"] == {"keep": 1, "review": 0, "drop": 0}
    summary = json.loads((tmp_path / "out.summary.json").read_text())
    assert summary["counters"]["output.drop"] == 3 and summary["counters"]["step.exact_deduplicate.drop"] == 1 and summary["counters"]["step.apply_quality_policy.drop"] == 1
    out = spark.read.json(str(tmp_path / "out")).first()
    assert out.source_id == "doc1" and len(out.record_sha256) == 64 and json.loads(out.data)["text_sha256"]


def test_strict_reader_stops(spark, tmp_path):
    for bad in ("{not json", "[1]", "3"):
        (tmp_path / "a.jsonl").write_text('{"a": 1}\n' + bad + "\n")
        with pytest.raises(Exception, match="not a JSON object"):
            readers.read_jsonl(spark, str(tmp_path / "a.jsonl")).collect()


def test_lenient_reader(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "", "content": "x"}\n[1]\n{bad\n\n{"body": "y"}\n{"text": 3}\n')
    (tmp_path / "b.txt").write_text("  one \n\n two\n")
    assert sorted(r.text for r in readers.read_corpus(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.txt")]).collect()) == ["one", "two", "x", "y"]
    assert sorted(r.text for r in readers.read_corpus(spark, [str(tmp_path)]).collect()) == ["x", "y"]


def test_common_marks(spark):
    got = js(spark, "general_text", [
        {"id": 1, "text": "long enough text here", "source": "s"}, {"id": 2, "text": 'my api_key = "abcdefghijkl1234" is here', "source": "s"}, {"id": 3, "text": "", "source": "s"},
        {"id": 4, "text": "x" * 40}, {"id": 5, "text": "STRASSE is a word in here", "source": "s"}, {"text": 7, "source": "s"},
    ], {"sensitive_terms": ["straße"], "max_chars": 39})
    assert [r.decision for r in got] == ["keep", "review", "drop", "review", "review", "drop"]
    assert [list(r.reasons) for r in got][1:] == [["possible_secret"], ["empty_training_text"], ["too_long", "missing_source"], ["sensitive_term"], ["empty_training_text"]]
    assert got[1].flags == ["possible_secret"] and got[4].flags == ["sensitive_term"]
    assert got[2].text_sha256 is None and "length" not in got[2].buckets and got[5].source_id == "set:5"


def test_license_rule(spark):
    got = js(spark, "general_text", [{"text": "long enough text a", "source": "s"}, {"text": "long enough text b", "source": "s", "metadata": {"license": "mit"}}], {"require_license": True})
    assert [r.flags for r in got] == [["missing_license"], []]


def test_quality_scores(spark):
    text = lambda k: f"document number {k} with enough text"
    scores = [4.5, "4.5", " ", True, "nan", "1_000", 3.5, 2.5, None]
    got = js(spark, "web", [{"text": text(k), "source": "s", "quality_mean": s} for k, s in enumerate(scores)], {"quality_policies": {"web": {**V.QUALITY_POLICIES["web"], "require_score": True}}})
    assert [r.decision for r in got] == ["keep", "keep", "review", "review", "keep", "keep", "review", "drop", "review"]
    hard = js(spark, "math", [{"question": "what is two and two?", "solution": "two and two is four, so the answer: 4 is right", "source": "s", "quality_score": 0.9, "hard_error_score": h} for h in (3, 4, "nan")], {"quality_policies": V.QUALITY_POLICIES})
    assert [r.reasons for r in hard][:2] == [[], ["hard_error_score_exceeded"]] and "hard_error_score_exceeded" not in hard[2].reasons


def test_stopping_step_keeps_its_marks(spark):
    line = "Sign in and accept all cookies, privacy policy, subscribe now"
    got = js(spark, "web", [{"text": "\n".join([line] * 6), "source": "s"}])[0]
    assert got.reasons == ["web_boilerplate", "repetitive_web_text"] and got.decision == "drop" and "topic" not in got.buckets


def test_web_qa(spark):
    got = js(spark, "web", [
        {"question": "why", "answer": "because of this and that", "source": "s"}, {"question": "what is it?", "answer": "N/A.", "source": "s"}, {"question": "what is it?", "answer": "unknown\nbut it may be this", "source": "s"},
        {"question": "what is it?", "answer": "it is known well", "source": "s", "grounded": False}, {"question": "what is it now?", "answer": "it is this", "source": "s", "grounded": None, "quality_score": 0.6, "topic": "t"},
    ])
    assert [r.reasons for r in got] == [["incomplete_qa_pair"], ["unknown_answer"], ["unknown_answer"], ["ungrounded_answer"], []]
    assert got[4].buckets["model_quality"] == "medium" and got[4].buckets["topic"] == "t" and got[4].buckets["subtype"] == "web_qa" and got[4].clean_text == "what is it now?\nit is this"


def test_code_content_becomes_text(spark):
    got = js(spark, "code", [{"content": "def f(x): return x", "language": "python", "source": "s"}, {"content": "kept as it is, long enough", "text": "def f(x):\n  return x\n\n\n\n# end", "metadata": {"language": "py"}, "source": "s"}], text_fields=("content",))
    assert [(r.clean_text, r.buckets["language"]) for r in got] == [("def f(x): return x", "python"), ("kept as it is, long enough", "py")]


def test_code_text(spark):
    rows = [{"text": "def g(x): return x", "path": "a/Vendor/b.py", "source": "s"}, {"text": "# Do not edit\ndef h(x):\n  return x", "source": "s"}, {"text": "plain words only here", "source": "s"}, {"text": "def p(x): return 1", "prefix": "a", "middle": "", "suffix": "b", "source": "s"}, {"text": "def q(x): return 2", "prefix": "a", "middle": "m", "suffix": "b", "source": "s", "tests_passed": 1}, {"text": "def r(x): return 3", "patch": "d", "source": "s"}, {"text": "x" * 5000 + " do not edit ();", "source": "s"}]
    got = js(spark, "code", rows)
    assert [r.reasons for r in got] == [["non_core_or_vendored_file"], ["possibly_generated_code"], ["weak_code_signal"], ["incomplete_fim_triplet"], [], [], []]
    assert got[4].buckets["subtype"] == "fim" and got[4].buckets["verified"] == "verified" and got[5].buckets["subtype"] == "patch"


def test_agentic(spark):
    m = lambda *x: [{"role": r, "content": c, **({"tool_calls": [{"n": 1}]} if r == "assistant" and c.startswith("call") else {})} for r, c in x]
    got = js(spark, "agentic", [
        {"messages": m(("user", "do the task now"), ("assistant", "call tool"), ("tool", "tests passed")), "source": "s", "tool_names": ["b", "a", "b"]}, {"messages": m(("assistant", "call tool now"), ("", "x")), "source": "s"},
        {"messages": m(("user", "please do this"), ("assistant", "call one"), ("assistant", "call two"), ("tool", "permission denied")), "source": "s"}, {"messages": m(("tool", "early observation"), ("assistant", "call tool")), "source": "s"},
        {"text": "just a text without structure", "source": "s"}, {"text": "rendered trace: all was a success", "pre_rendered_agent_trace": True, "source": "s"},
    ])
    assert [list(r.reasons) for r in got] == [[], ["invalid_first_role", "missing_message_role"], ["unpaired_tool_call", "failed_or_environment_trajectory"], ["invalid_first_role", "unpaired_tool_call"], ["unstructured_agent_trace", "no_tool_call"], []]
    assert got[0].clean_text.startswith("user: do the task now\nassistant: call tool") and got[0].buckets["tool_family"] == "a,b" and got[0].buckets["outcome"] == "verified" and got[0].metrics["turns"] == 3.0
    assert "tool_calls" not in got[5].metrics and got[5].buckets["outcome"] == "verified"


def test_instruction(spark):
    got = js(spark, "instruction", [
        {"instruction": "Say something long", "output": "As an AI language model I say it", "source": "s"}, {"prompt": "Same text as that", "response": "SAME TEXT AS THAT", "source": "s"}, {"prompt": "only a prompt here it is", "source": "s", "text": "text that is long enough"},
        {"messages": [{"role": "user", "content": "hello there friend"}, {"role": "assistant", "content": "hi"}, {"role": "user", "content": "bye"}], "source": "s"}, {"messages": [{"role": "user", "content": "hello there again"}], "source": "s"},
    ])
    assert [list(r.reasons) for r in got] == [["generic_model_template"], ["prompt_response_identical"], ["incomplete_instruction_pair"], [], ["incomplete_instruction_messages"]]
    assert got[3].buckets["turns"] == "multi" and got[3].clean_text == "user: hello there friend\nassistant: hi\nuser: bye"


def test_math_and_reasoning(spark):
    got = js(spark, "math", [
        {"problem": "see the figure and solve", "solution": "therefore it is equal to four, quite clearly so", "source": "s"}, {"problem": "see the figure and solve it", "solution": "therefore it is equal to four, quite clearly so", "image_text": "a square", "verified": True, "source": "s"},
        {"problem": "what is one and one", "solution": "2", "answer": "2", "verified": False, "source": "s", "chapter": 1}, {"text": "no fields but a long text", "source": "s"},
    ])
    assert [list(r.reasons) for r in got] == [["missing_multimodal_context"], [], ["solution_too_short", "verifier_failed"], ["missing_problem_or_solution"]]
    assert got[1].buckets["verified"] == "verified" and got[2].buckets["form"] == "textbook"
    got = js(spark, "reasoning", [
        {"prompt": "solve this thing", "response": "because " + "x" * 56, "final_answer": "4", "source": "s", "teacher_model": "t", "source_row_hash": "h"}, {"prompt": "solve this one", "response": "because " + "x" * 55, "answer": "4", "source": "s"},
        {"problem": "p <|user|> artifact", "reasoning": "first, " + "y" * 80, "source": "s"}, {"text": "nothing but text is here", "source": "s"},
    ])
    assert [list(r.reasons) for r in got] == [[], ["weak_reasoning_signal"], ["control_or_prompt_artifact", "missing_final_answer"], ["missing_reasoning", "missing_final_answer"]]
    assert got[0].buckets["origin"] == "teacher_rewrite" and got[0].renewed["lineage_hash"] == "h" and got[0].clean_text.endswith("\n4")


def test_typed_columns_and_partitions(spark):
    docs = spark.createDataFrame([(k, f"text number {k % 7} that is long enough", "s") for k in range(40)], "id bigint, text string, source string")
    want = None
    for n in (1, 4, 8):
        out = P.build_pipeline("general_text", {"near_dedup": True}).run(docs.repartition(n), "set", seq="id").select("seq", "decision").collect()
        got = sorted((r.seq, r.decision) for r in out)
        want = want or got
        assert got == want
    assert len(want) == 7


def test_empty_table_and_bad_config(spark):
    docs = spark.createDataFrame([], "id bigint, text string, source string")
    assert P.release(P.build_pipeline("web").run(docs, "set", seq="id")).count() == 0
    assert {r.decision: r.n for r in P.manifest(P.build_pipeline("web").run(docs, "set", seq="id")).collect()} == {"keep": 0, "review": 0, "drop": 0}
    for bad in (lambda: P.build_pipeline("nope"), lambda: P.build_pipeline("web", {"nope": 1})):
        with pytest.raises(ValueError):
            bad()
    assert P.load_config({"min_chars": 3}, {"quality_policies": {"web": {}}, "near_dedup": True, "other": 1}) == {"min_chars": 3, "quality_policies": {"web": {}}, "near_dedup": True}


# --- planning ---------------------------------------------------------------


def test_quotas(spark):
    assert mixture.allocate({"code": 0.5, "web": 0.3, "math": 0.2, "none": 0, "less": -1}, 11) == {"code": 6, "web": 3, "math": 2}
    rows = spark.createDataFrame([("code", 0.5), ("web", 0.3), ("math", 0.2), ("none", 0.0)], "source string, weight double")
    assert {r.source: r.quota for r in mixture.quotas(rows, 11).collect()} == {"code": 6, "web": 3, "math": 2}
    with pytest.raises(ValueError):
        mixture.allocate({"a": 0}, 3)


def test_select_mixed(spark):
    ids = spark.createDataFrame([(f"w{k}", "web") for k in range(5)] + [(f"c{k}", "code") for k in range(3)], "id string, source string")
    shares = spark.createDataFrame([("web", 3), ("code", 2)], "source string, quota bigint")
    for method in ("md5", "blake2b"):
        got = [r.id for r in mixture.select_mixed(ids, shares, "seed", method=method).collect()]
        assert len(set(got)) == 5 and sum(x[0] == "w" for x in got) == 3
        assert got == [r.id for r in mixture.select_mixed(ids.repartition(3), shares, "seed", method=method).collect()]
    with pytest.raises(Exception, match="code needs 9"):
        mixture.select_mixed(ids, spark.createDataFrame([("code", 9)], "source string, quota bigint"), "s").collect()


def test_prefix_mix(spark):
    rows = spark.createDataFrame([(f"a{k}", "B4K") for k in range(6)] + [(f"b{k}", "B16K") for k in range(3)] + [("c", "B64K")], "id string, bucket string")
    got = mixture.prefix_context_mix(rows, {"B4K": 3, "B16K": 2, "B64K": 1}, "s").collect()
    assert len({r.id for r in got}) == 6 and sorted(r.final for r in got) == ["B16K", "B16K", "B4K", "B4K", "B4K", "B64K"]
    with pytest.raises(ValueError):
        mixture.prefix_context_mix(rows, {"B4K": 99}, "s")
    own = mixture.context_order({"B4K": 1, "B16K": 1}, eligible={"B16K": ["B16K"], "B4K": ["B4K", "B64K"]})
    assert own == [("B4K", ("B4K", "B64K")), ("B16K", ("B16K",))]


def test_balance():
    got = mixture.balance([("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", -1)], 2)
    assert [[k for k, _ in w] for w in got] == [["a", "d"], ["b", "c", "e"]]
    with pytest.raises(ValueError):
        mixture.balance([], 0)


def test_packing(spark):
    rows = [([1] * 10, "a"), ([1] * 10, "b"), ([1] * 5, "c"), ([1] * 16, "long"), ([1] * 5, "c")]
    df = spark.createDataFrame(rows, "tokens array<int>, source_id string")
    packed, over = packing.pack(df, 15)
    got = packed.collect()
    assert [r.source_id for r in over.collect()] == ["long"]
    assert sorted(x for r in got for x in r.source_ids) == ["a", "b", "c", "c"] and all(len(r.tokens) <= 15 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == len(r.tokens) for r in got)
    assert packing.best_fit([(10, "a"), (10, "b"), (5, "c")], 15) == [("a", 0, 0), ("b", 1, 0), ("c", 0, 1)]
    kept, _ = packing.pack(df, 15, allow_overlength=True)
    assert sorted(len(r.tokens) for r in kept.collect())[-1] == 16
    for bad, schema in (([([], "x")], "tokens array<int>, source_id string"), ([([1], "x", [-100])], "tokens array<int>, source_id string, targets array<int>"), ([([1], "x", [1, 2])], "tokens array<int>, source_id string, targets array<int>"), ([([1], "x", [1]), ([1], "y", None)], "tokens array<int>, source_id string, targets array<int>")):
        with pytest.raises(Exception):
            packing.pack(spark.createDataFrame(bad, schema), 15)[0].collect()


# --- tokenizers -------------------------------------------------------------


def test_tokenizers(spark, tmp_path):
    texts = ["def hello(): return 1", "hello world of words", "1 + 2 = 3", "你好世界"] * 30
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    for kind in tokens.MODEL_TYPES:
        t = tokens.train(df, model_type=kind, vocab_size=400)
        assert all(len(r.tokens) for r in tokens.encode(df, t).collect())
    t = tokens.train(df, vocab_size=500)
    assert t.token_to_id("<|think_start|>") is not None
    assert sorted(r.text for r in tokens.decode(tokens.encode(df.select("id", "text"), t).drop("text"), t).collect()) == sorted(texts)
    tokens.save(t, str(tmp_path / "tok"))
    tokens.with_template(str(tmp_path / "tok"), X.chat_template())
    assert tokens.load(str(tmp_path / "tok")).encode(texts[0]).ids == t.encode(texts[0]).ids
    r = tokens.compression(df, t).first()
    assert r.samples == 120 and r.total_tokens == sum(len(t.encode(x).ids) for x in texts) and len(r.top_10_tokens) == 10 and r.bytes_per_token > 0
    assert tokens.compression(df.where("id < 0"), t).count() == 0
    assert tokens.compare(df, {"a": t, "b": t}).count() == 2 and tokens.out_of_vocabulary(df, t).first().unknown_tokens == 0
    assert tokens.tokenize(df, t, stem="f").where("source_id = '7'").count() == 1
    with pytest.raises(ValueError):
        tokens.create("nope")
    with pytest.raises(ValueError):
        tokens.named_config([{"name": "a"}], "b")


def test_presets(spark):
    got = {r.name: r.total for r in R.parameters(R.presets(spark)).collect()}
    assert got["tiny"] == 4_409_600 and got["small"] == 35_267_072 and got["base"] == 176_179_968 and got["medium"] == 417_383_424 and got["large"] == 6_207_836_160
    small = R.layers(R.presets(spark).where("name = 'small'")).collect()
    assert [r.layer for r in small if r.attention == "full"] == [0, 4] and [r.layer for r in small if r.rope] == [0, 2, 4, 6]


def test_presets_of_a_file(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"presets": {"odd": {"hidden_size": 100, "num_heads": 8, "rope_percent": 1.5, "notes": "n"}, "plain": {"num_layers": 2}}}))
    got = {r.name: r for r in R.presets(spark, str(path)).collect()}
    assert (got["odd"].heads_divide_hidden, got["odd"].rope_percent_in_range) == (False, False)
    plain = got["plain"]
    assert (plain.layers, plain.hidden, plain.kv_heads, plain.rope_base, plain.tied) == (2, 512, 4, 500000.0, True) and plain.rope_percent_in_range and plain.kv_divides_heads
    assert R.preset(spark, "plain", str(path))["window"] == 128 and all(r.rope_percent_in_range for r in R.presets(spark).collect())
    with pytest.raises(ValueError):
        R.preset(spark, "none", str(path))
    path.write_text(json.dumps({"presets": {"bad": {"layer": 2}}}))
    with pytest.raises(ValueError, match="layer"):
        R.presets(spark, str(path))


def test_source_report(spark, tmp_path):
    from siltworks.sources import sinks

    rows = spark.createDataFrame([("b", "ok", 0.12345, 3), ("a", "failed", None, 0)], "name string, status string, cumulative_gb double, data_files int")
    sinks.write_source_report(rows, str(tmp_path / "r.json"), at="now")
    got = json.loads((tmp_path / "r.json").read_text())
    assert [(x["name"], x["status"], x["cumulative_gb"], x["data_files"], x["error"]) for x in got["sources"]] == [("a", "failed", None, 0, None), ("b", "ok", 0.123, 3, None)] and got["generated_at"] == "now"
    assert sinks.write_source_report(rows.limit(0), str(tmp_path / "e.json"))["sources"] == []


def test_catalog(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"name": "a", "max_size_gb": 1, "include_patterns": ["x/*.gz"]}]}))
    assert catalog.load_catalog(spark, str(tmp_path / "c.json")).first().include_patterns == ["x/*.gz"]
    files = spark.createDataFrame([("x/a.gz", 5), ("x/y/b.gz", 5), ("x/c.txt", 5), ("x/d.gz", 5)], "path string, size bigint")
    got = catalog.plan_fetch(files, 6, ["x/*.gz"], present=spark.createDataFrame([("x/a.gz", 5)], "path string, size bigint")).orderBy("path").collect()
    assert [(r.path, r.action) for r in got] == [("x/a.gz", "skip"), ("x/d.gz", "fetch")]
    assert catalog.plan_fetch(files, 6, ["x/*.gz"], test=True).count() == 1
    res = spark.createDataFrame([("a", "fetched", 1), ("a", "failed", 1), ("b", "failed", 1), ("c", None, None), ("d", "skipped", 2)], "name string, outcome string, size bigint")
    assert {r.name: r.status for r in catalog.source_status(res).collect()} == {"a": "partial", "b": "failed", "c": "empty", "d": "ok"}


def test_chat_template_text(spark):
    m = spark.createDataFrame([([("user", "hi", None), ("assistant", "yo", "hm")],)], "m array<struct<role:string,content:string,reasoning_content:string>>")
    got = m.select(X.chat_text_with_reasoning(F.col("m")).alias("t")).first().t
    assert got == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|think_start|>hm<|think_end|>\nyo<|im_end|>\n"


def test_streams(spark, tmp_path):
    from siltworks.streaming import dedup as S

    src = tmp_path / "in"
    src.mkdir()
    rows = [(1, "a text that repeats often in here"), (2, "A text that repeats  often in here"), (3, "another text that is not the same"), (4, "another text that is not the same!")]
    for k, r in enumerate(rows):
        (src / f"{k}.json").write_text(json.dumps({"seq": r[0], "text": r[1]}))
    stream = lambda: spark.readStream.schema("seq bigint, text string").option("maxFilesPerTrigger", 1).json(str(src))
    q = S.exact_stream(stream()).writeStream.format("memory").queryName("uniq").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("uniq").count() == 3
    out = []
    near = S.NearStream(str(tmp_path / "seen"), lambda df, n: out.extend((r.seq, r.is_near_duplicate) for r in df.collect()))
    q = stream().writeStream.foreachBatch(near.handler).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert sum(x for _, x in out) == 2 and len(out) == 4


def test_near_duplicates_by_longer_keys(spark):
    r = random.Random(9)
    prints = [r.getrandbits(63) for _ in range(40)]
    for _ in range(160):
        x = r.choice(prints)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randint(0, 62)
        prints.append(x)
    want = {k for k, x in enumerate(prints) if any((x ^ y).bit_count() <= 3 for y in prints[:k])}
    df = spark.createDataFrame(list(enumerate(prints)), "seq bigint, fp bigint")
    for match in (1, 3):
        assert {x.seq for x in dedup.near_duplicates(df, match=match).collect()} == want


def test_least_keys_is_an_exact_top(spark):
    r = random.Random(4)
    rows = [(f"{k}", r.choice("ab"), f"{r.getrandbits(20):05x}{'0' * 27}") for k in range(900)]
    df = spark.createDataFrame(rows, "id string, source string, key string").withColumn("n", F.when(F.col("source") == "a", 37).otherwise(0))
    got = {x.id for x in mixture.least_keys(df, ["source"], "n").collect()}
    assert got == {i for i, _, k in sorted((x for x in rows if x[1] == "a"), key=lambda x: (x[2], x[0]))[:37]}


def test_zstd_and_config(spark, tmp_path):
    import zstandard

    (tmp_path / "a.jsonl.zst").write_bytes(zstandard.compress(b'{"text": "from zstd"}\n'))
    assert readers.read_jsonl_lenient(spark, str(tmp_path / "a.jsonl.zst")).first().text == "from zstd"
    (tmp_path / "c.json").write_text('{"web": {"keep_min": 1}}')
    assert P.load_config(None, P.read_config(str(tmp_path / "c.json"))) == {"quality_policies": {"web": {"keep_min": 1}}}
    with pytest.raises(FileNotFoundError):
        P.read_config(str(tmp_path / "none.json"))


def test_tokenizer_trains_on_all_texts(spark):
    from siltworks.operators import tokens

    n = 1_000_000  # the texts that were read at most
    rows = spark.range(0, n + 100, 1, 1)
    t = tokens.train(rows.selectExpr(f"if(id < {n}, 'a', 'qqqq') AS text"), vocab_size=400)
    assert t.token_to_id("qqqq") is not None


def test_input_order_of_several_files(spark, tmp_path):
    """Of copies in two files the one that stands first in path order stays, whatever the files' sizes."""
    same = "the same text stands in both of the files here"
    (tmp_path / "a.jsonl").write_text(json.dumps({"text": same, "source": "a"}) + "\n\n" + json.dumps({"text": "another text of the first file, long enough", "source": "a"}) + "\n")
    (tmp_path / "b.jsonl").write_text("".join(json.dumps({"text": f"row {k} of the second file " + "x" * 400, "source": "b"}) + "\n" for k in range(3000)) + json.dumps({"text": same, "source": "b"}) + "\n")
    rows = P.build_pipeline("general_text").run(readers.read_jsonl(spark, str(tmp_path)), "d", keep_dropped=True)
    got = {r.seq: r for r in rows.select("seq", "source_id", "decision", "clean_text").collect()}
    assert sorted(got) == list(range(3003)) and got[0].clean_text == same and got[0].decision == "keep" and got[0].source_id == "d:0"
    assert [k for k, r in got.items() if r.decision == "drop"] == [3002] and got[7].clean_text.startswith("row 5 ")


def test_numbers_within_files(spark, tmp_path):
    spark.range(100).selectExpr("id AS text").repartition(3).write.parquet(str(tmp_path / "p"))
    rows = readers.numbered(spark.read.parquet(str(tmp_path / "p")).selectExpr("text", "_metadata.file_path AS f"), "n", each_file=True)
    for _, own in rows.toPandas().groupby("f"):
        assert sorted(own.n) == list(range(len(own)))
    assert sorted(r.seq for r in readers.numbered(spark.read.parquet(str(tmp_path / "p"))).collect()) == list(range(100))


def test_duplicate_joins_move_no_texts(spark, tmp_path):
    """Rows meet the written list of duplicates by broadcast: no exchange of the plan holds a text."""
    spark.createDataFrame([(k, f"a text of some length {k % 7}") for k in range(50)], "id bigint, text string").write.parquet(str(tmp_path / "t"))
    rows = P.build_pipeline("general_text", {"near_dedup": True}).run(spark.read.parquet(str(tmp_path / "t")), "d", seq="id", keep_dropped=True)
    assert rows.where("decision = 'drop'").count() == 43
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_tokenize_command_over_folders(spark, tmp_path):
    from siltworks.operators import tokens

    folder = tmp_path / "in"
    spark.createDataFrame([(f"word {k} of parquet", "p" if k % 2 else None) for k in range(6)], "text string, source string").coalesce(1).write.parquet(str(folder / "c"))
    (folder / "a.jsonl").write_text("".join(json.dumps({"text": f"line {k}", "id": k}) + "\n" for k in range(3)) + "no json\n")
    (folder / "b.json").write_text(json.dumps({"content": "other field"}) + "\n")
    (folder / "notes.txt").write_text("not read in a folder\n")
    t = tokens.train(spark.createDataFrame([("line word of parquet other field 0123456789",)], "text string"), vocab_size=300)
    rows = tokens.tokenize_files(spark, t, [str(folder)])
    got = {r.source_id: r for r in rows.collect()}
    assert len(got) == 10 and got["a:0"].source == "a" and got["1"].tokens == t.encode("line 1").ids and got["b:0"].source == "b"  # an id of 0 is none
    assert {r.source for r in got.values()} > {"a", "b", "p"}
    assert {r.source for r in tokens.tokenize_files(spark, t, [str(folder)], max_files=2).collect()} == {"a", "b"}
    assert {r.source for r in tokens.tokenize_files(spark, t, [str(folder)], max_tokens=1).collect()} == {"a"}
    assert tokens.tokenize_files(spark, t, [str(folder / "notes.txt")]).count() == 1
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        tokens.tokenize_files(spark, t, [str(tmp_path / "empty")])


def test_shared_folder_is_asked_for_on_clusters(spark):
    from siltworks.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared_root(Session())


def test_near_duplicates_of_short_keys_by_blocks(spark, monkeypatch):
    """Within 15 bits all pairs are compared in blocks of arrays; no table of keys is made of them."""
    monkeypatch.setattr(dedup, "BLOCKS", 3)
    r = random.Random(8)
    prints = [r.getrandbits(64) - 2**63 for _ in range(150)]
    for _ in range(150):
        x = r.choice(prints) & (2**64 - 1)
        for b in r.sample(range(64), r.randint(0, 20)):
            x ^= 1 << b
        prints.append(x - 2**64 if x >> 63 else x)
    want = {k for k, x in enumerate(prints) if any(((x ^ y) & (2**64 - 1)).bit_count() <= 15 for y in prints[:k])}
    rows = [*enumerate(prints), (len(prints), None)]
    got = dedup.near_duplicates(spark.createDataFrame(rows, "seq bigint, fp bigint"), 15, 16)
    assert {x.seq for x in got.collect()} == want and 0 < len(want) < 300
    assert "posexplode" not in got._jdf.queryExecution().toString()
    assert dedup.near_duplicates(spark.createDataFrame([], "seq bigint, fp bigint"), 15, 16).count() == 0


def test_keys_of_fingerprints_are_not_sent_to_the_driver(spark):
    """The keys are many times the rows that the planner judges a broadcast by."""
    near = dedup.near_by_keys(spark.range(100).selectExpr("id AS fp", "id AS first"), 3, 2)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()


def test_tokenizer_from_word_counts(spark, monkeypatch):
    """Merges made from counts of words are the library's; no text comes to the driver."""
    from siltworks.operators import bpe, tokens

    r = random.Random(3)
    bits = ["a", "aa", "ab", "the", "he", "to", "ol", "ß", "你好", " ", "  ", "\n", "'ll", "12", "!!", "\t", "user", "é"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 60))) for _ in range(600)] + ["", "a" * 999, None]
    df = spark.createDataFrame([(x,) for x in texts], "text string").repartition(3)
    for size in (300, 700, 5000):
        want = tokens.train(df, vocab_size=size).to_str()
        with monkeypatch.context() as m:
            m.setattr(tokens, "SMALL", 0)
            m.setattr(bpe, "CHUNK", 500)
            m.setattr(bpe, "HELD", 50)
            m.setattr(type(df), "toLocalIterator", lambda self, *_, of=type(df).toLocalIterator: of(self) if self.columns != ["text"] else 1 / 0)
            got = tokens.train(df, vocab_size=size).to_str()
        assert json.loads(got) == json.loads(want)


def test_running_sums_in_ranges(spark):
    """A large group is summed in several ranges; rows of one place share their sum, a null group is a group."""
    rows = [(k // 2 if g != "b" else k, g, 1 + k % 7) for g in ("a", "b", None) for k in range(300)]
    df = spark.createDataFrame(rows, "at int, g string, n bigint").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = packing.running_sums(df, "n", "g", "at", "stop")
        got = sorted(map(tuple, out.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(((a, g, n, sum(x for b, h, x in rows if h == g and b <= a)) for a, g, n in rows), key=repr)
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__range" in plan and "hashpartitioning(g" not in plan.split("BroadcastExchange")[0]


def test_offsets_move_no_texts(spark):
    from siltworks.plans import queries

    from . import oracle

    if not os.path.isdir(oracle.DATA):
        pytest.skip("no test tables here")
    # texts are in no exchange: what is left to do reads numbers only
    plan = queries.sequence_offsets(spark, oracle.DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "text#" not in plan


def test_quality_policy_of_texts_with_secrets(spark, tmp_path):
    """The query equals its SQL where the scan for secrets, which the SQL leaves out, has marked rows."""
    import duckdb

    from siltworks.plans import queries

    from . import oracle

    text = "a line with password = 'abcdef0123456789' in it, number "
    docs = [(k, text + str(k // 2), "en", "src0" if k % 3 else "src1", 40 * k) for k in range(40)] + [(40, "short", "en", "src0", 5)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, k % 2, 0) for k in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(oracle, "DATA", str(tmp_path))
        oracle.check(spark, con, queries.QUERIES["quality_policy"], queries.ORACLES["quality_policy"])
