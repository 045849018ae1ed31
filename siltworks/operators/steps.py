"""Row-local steps of every category.

A schema step chooses the fields that form the text; it runs before they are
normalised.  Other steps see the normalised text, and the normalised value of
fields that are part of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..sources.fields import Fields
from .effects import Effects


@dataclass
class Row:
    """The record as the steps see it.

    parts: alternatives (condition, names of the text fields), the first whose
    condition holds counts.  text and folded are set once they are computed.
    """

    fields: Fields
    effects: Effects
    config: dict
    parts: list[tuple[Column, tuple[str, ...]]] = field(default_factory=list)
    messages: Column | None = None
    text: Column | None = None
    folded: Column | None = None


Step = Callable[[Row], None]


def both(f: Fields, a: str, b: str) -> Column:
    return f.string(a).isNotNull() & f.string(b).isNotNull()


def copy_absent(f: Fields, source: str, target: str) -> None:
    """target takes source's value where only source is there."""
    f.put(target, F.when(f.present(target), f.string(target)).when(f.present(source), f.string(source)))


def rendered(messages: Column) -> Column:
    """Role and content of the messages that say something, a line each; null if none does."""
    spoken = F.filter(messages, lambda m: F.length(m.content) > 0)
    lines = F.transform(spoken, lambda m: F.concat(F.coalesce(F.nullif(m.role, F.lit("")), F.lit("unknown")), F.lit(": "), m.content))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def any_inside(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


# --- common -----------------------------------------------------------------


def basic_integrity(r: Row) -> None:
    n = F.length(r.text)
    low, high = int(r.config.get("min_chars", V.MIN_CHARS)), int(r.config.get("max_chars", V.MAX_CHARS))
    r.effects.drop(n == 0, "empty_training_text")
    r.effects.drop((n > 0) & (n < low), "too_short")
    r.effects.review((n >= low) & (n > high) & (n > 0), "too_long")


def provenance(r: Row) -> None:
    f = r.fields
    if r.config.get("require_license"):
        r.effects.review(~(f.truthy("license") | f.truthy("metadata.license")), "missing_license", flag=True)
    r.effects.review(~f.truthy("source"), "missing_source", flag=True)


def sensitive_content(r: Row) -> None:
    r.effects.review(F.rlike(r.text, F.lit(V.SECRET)), "possible_secret", flag=True)
    terms = [str(t).casefold() for t in r.config.get("sensitive_terms") or () if str(t)]
    if terms:
        r.effects.review(any_inside(r.folded, terms), "sensitive_term", flag=True)


def quality_policy(r: Row) -> None:
    """Thresholds of the policy of the record's key, else of its category, else the default.

    Below review_min a record is dropped, below keep_min it is reviewed.
    """
    policies = r.config.get("quality_policies")
    if not policies:
        return
    f, category = r.fields, r.config["category"]
    key = F.coalesce(f.first("source_key", "source"), F.lit(r.config["dataset"] or category))
    general = policies.get(category) or policies.get("default")
    named = {k: p for k, p in policies.items() if p}
    cases = [(key == k, p) for k, p in named.items()]
    if general:
        cases.append((~F.coalesce(key.isin(*named), F.lit(False)) if named else F.lit(True), general))
    scores, errors = None, None
    below, under, missing, wrong = (F.lit(False) for _ in range(4))
    for when, p in cases:
        score = f.number(p.get("score_field", "quality_score"))
        scores = F.coalesce(scores, F.when(when, score)) if scores is not None else F.when(when, score)
        low = score < p["review_min"] if p.get("review_min") is not None else F.lit(False)
        mid = score < p["keep_min"] if p.get("keep_min") is not None else F.lit(False)
        # NaN is above all numbers here and below none of them
        below, under = below | (when & low), under | (when & ~low & mid)
        if p.get("require_score"):
            missing = missing | (when & score.isNull())
        if p.get("hard_error_field") and p.get("hard_error_max") is not None:
            hard = f.number(p["hard_error_field"])
            errors = F.coalesce(errors, F.when(when, hard)) if errors is not None else F.when(when, hard)
            wrong = wrong | (when & (hard > p["hard_error_max"]) & ~F.isnan(hard))
    yes = lambda c: F.coalesce(c, F.lit(False))
    r.effects.review(yes(missing), "missing_quality_score", flag=True)
    if scores is not None:
        r.effects.metric("quality_score", scores)
    r.effects.drop(yes(below), "quality_score_below_drop_threshold")
    r.effects.review(yes(under), "quality_score_below_keep_threshold")
    if errors is not None:
        r.effects.metric("hard_error_score", errors)
    r.effects.drop(yes(wrong), "hard_error_score_exceeded")


# --- web --------------------------------------------------------------------


def web_schema(r: Row) -> None:
    qa = both(r.fields, "question", "answer")
    r.parts.append((qa, ("question", "answer")))
    r.effects.bucket("subtype", F.when(qa, "web_qa").otherwise("web_text"))


def web_boilerplate(r: Row) -> None:
    limit = int(r.config.get("web_boilerplate_limit", 4))
    r.effects.review(F.regexp_count(r.text, F.lit(V.BOILERPLATE)) >= limit, "web_boilerplate")
    r.effects.drop(F.coalesce(X.distinct_line_ratio(r.text) < F.lit(0.45), F.lit(False)), "repetitive_web_text")


def web_qa(r: Row) -> None:
    f = r.fields
    qa = both(f, "question", "answer")
    question, answer = (F.coalesce(f.string(k), F.lit("")) for k in ("question", "answer"))
    short = (F.length(question) < 4) | (F.length(answer) == 0)
    # the pattern is anchored at the start of the answer, and may end at any line end
    unknown = F.rlike(answer, F.lit(V.UNKNOWN_ANSWER.replace("(?i)^", r"(?i)\A(?m:").removesuffix("$") + "$)"))
    r.effects.drop(qa & short, "incomplete_qa_pair")
    r.effects.drop(qa & ~short & unknown, "unknown_answer")
    r.effects.review(qa & F.coalesce(~f.boolean("grounded"), F.lit(False)), "ungrounded_answer")


def web_buckets(r: Row) -> None:
    f = r.fields
    r.effects.bucket("topic", f.first("topic_top1", "topic", default="unknown"))
    score = f.plain_number("quality_score")
    r.effects.bucket("model_quality", F.when(score.isNull(), None).when(F.isnan(score), "low").when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low"))


# --- code -------------------------------------------------------------------


def code_schema(r: Row) -> None:
    f = r.fields
    moved = f.present("content") & ~f.present("text")
    value = F.when(moved, f.string("content")).otherwise(f.string("text"))
    names = tuple(r.config["text_fields"])
    r.effects.bucket("subtype", f.first("subtype", default="code"))
    f.put("text", value)
    r.parts.append((moved, tuple("text" if n == "content" else n for n in names)))


def code_language(r: Row) -> None:
    r.effects.bucket("language", r.fields.first("language", "metadata.language", default="unknown"))


def code_assets(r: Row) -> None:
    # paths are compared in folded form; parts are given by the configuration
    path = X.casefold(r.fields.first("path", "file_path", default=""))
    denied = [str(x).casefold() for x in r.config.get("code_denied_path_parts", V.DENIED_PATH_PARTS)]
    bad = (F.length(path) > 0) & any_inside(path, denied)
    r.effects.drop(bad, "non_core_or_vendored_file")
    r.effects.review(~bad & F.rlike(F.substring(r.text, 1, 4096), F.lit(V.GENERATED_CODE)), "possibly_generated_code")


def code_signal(r: Row) -> None:
    f = r.fields
    r.effects.review(~F.rlike(r.text, F.lit(V.CODE_SIGNAL)) & (F.size(X.lines(r.text)) < 3), "weak_code_signal")
    keys = ("prefix", "middle", "suffix")
    any_key = f.present(keys[0]) | f.present(keys[1]) | f.present(keys[2])
    full = F.lit(True)
    for k in keys:
        full = full & F.coalesce(F.length(f.string(k)) > 0, F.lit(False))
    r.effects.drop(any_key & ~full, "incomplete_fim_triplet")
    r.effects.bucket("subtype", F.when(any_key & full, "fim"))


def code_task(r: Row) -> None:
    f = r.fields
    r.effects.bucket("subtype", F.when(f.truthy("patch") | f.truthy("diff"), "patch").when(f.truthy("prompt") & f.truthy("completion"), "code_qa"))
    r.effects.bucket("verified", F.when(f.truthy("verified") | f.truthy("tests_passed"), "verified").otherwise("unverified"))


# --- agentic ----------------------------------------------------------------


def agentic_schema(r: Row) -> None:
    f = r.fields
    r.messages = f.messages("messages", "trajectory")
    count = F.coalesce(F.size(r.messages), F.lit(0))
    count = F.when(count < 0, 0).otherwise(count)
    had_text = f.string("text").isNotNull()
    made = F.when((count > 0) & ~had_text, rendered(r.messages))
    r.effects.review((count == 0) & had_text & ~f.truthy("pre_rendered_agent_trace"), "unstructured_agent_trace")
    r.effects.metric("turns", count)
    r.effects.bucket("subtype", f.first("sample_type", default="trajectory"))
    r.parts.append((made.isNotNull(), ("text",)))
    f.put("text", F.coalesce(made, f.string("text")))


def role_order(r: Row) -> None:
    roles = F.transform(r.messages, lambda m: F.coalesce(m.role, F.lit("")))
    some = F.coalesce(F.size(roles) > 0, F.lit(False))
    r.effects.review(some & ~F.coalesce(F.get(roles, F.lit(0)).isin("system", "user"), F.lit(False)), "invalid_first_role")
    r.effects.drop(some & F.coalesce(F.exists(roles, lambda x: x == ""), F.lit(False)), "missing_message_role")


def tool_pairs(r: Row) -> None:
    checked = ~r.fields.truthy("pre_rendered_agent_trace")
    zero = F.struct(*(F.lit(0).alias(k) for k in ("pending", "calls", "seen")))

    def fold(a: Column, m: Column) -> Column:
        call = (m.has_call | F.coalesce(m.role.isin(*V.CALL_ROLES), F.lit(False))).cast("int")
        seen = F.coalesce(m.role.isin(*V.OBSERVATION_ROLES), F.lit(False)).cast("int")
        return F.struct(F.greatest(F.lit(0), a.pending + call - seen).alias("pending"), (a.calls + call).alias("calls"), (a.seen + seen).alias("seen"))

    t = F.aggregate(F.coalesce(r.messages, F.array().cast("array<struct<role:string,content:string,has_call:boolean>>")), zero, fold)
    r.effects.metric("tool_calls", F.when(checked, t.calls))
    r.effects.metric("tool_observations", F.when(checked, t.seen))
    r.effects.review(checked & (t.calls == 0), "no_tool_call")
    r.effects.review(checked & (t.calls > 0) & (t.pending > 0), "unpaired_tool_call")


def outcome(r: Row) -> None:
    failed = any_inside(r.folded, V.FAILURE_MARKERS)
    verified = r.fields.truthy("verified") | r.fields.truthy("tests_passed") | any_inside(r.folded, V.SUCCESS_MARKERS)
    r.effects.bucket("outcome", F.when(verified, "verified").when(failed, "failed").otherwise("weak"))
    r.effects.review(failed & ~verified, "failed_or_environment_trajectory")


def tool_family(r: Row) -> None:
    f = r.fields
    names = F.coalesce(*(F.when(f.truthy(k), f.strings(k)) for k in ("tool_names", "target_tools")))
    r.effects.bucket("tool_family", F.coalesce(F.when(F.size(names) > 0, F.array_join(F.array_sort(F.array_distinct(names)), ",")), F.lit("unknown")))


# --- instruction ------------------------------------------------------------


def instruction_schema(r: Row) -> None:
    f = r.fields
    copy_absent(f, "instruction", "prompt")
    copy_absent(f, "output", "response")
    r.messages = f.messages("messages")
    pair = both(f, "prompt", "response")
    made = F.when(~pair, rendered(r.messages))
    r.parts += [(pair, ("prompt", "response")), (made.isNotNull(), ("text",))]
    f.put("text", F.coalesce(made, f.string("text")))


def instruction_pair(r: Row) -> None:
    f = r.fields
    chat = F.coalesce(F.size(r.messages) > 0, F.lit(False))
    roles = F.transform(r.messages, lambda m: F.coalesce(m.role, F.lit("")))
    whole = F.coalesce(F.array_contains(roles, "user") & F.array_contains(roles, "assistant"), F.lit(False))
    prompt, response = f.first("prompt", default=""), f.first("response", default="")
    empty = (F.length(prompt) == 0) | (F.length(response) == 0)
    r.effects.drop(chat & ~whole, "incomplete_instruction_messages")
    r.effects.drop(~chat & empty, "incomplete_instruction_pair")
    r.effects.drop(~chat & ~empty & (X.casefold(prompt) == X.casefold(response)), "prompt_response_identical")


def instruction_templates(r: Row) -> None:
    r.effects.review(F.rlike(r.fields.first("response", default=""), F.lit(V.CANNED_RESPONSE)), "generic_model_template")


def instruction_buckets(r: Row) -> None:
    f = r.fields
    r.effects.bucket("task", f.first("task", "category", default="general"))
    r.effects.bucket("risk", f.first("risk_category", default="normal"))
    r.effects.bucket("turns", F.when(F.coalesce(F.size(r.messages) > 2, F.lit(False)), "multi").otherwise("single"))


# --- math -------------------------------------------------------------------


def math_schema(r: Row) -> None:
    copy_absent(r.fields, "problem", "question")
    copy_absent(r.fields, "response", "solution")
    r.parts.append((both(r.fields, "question", "solution"), ("question", "solution")))


def problem_solution(r: Row) -> None:
    f = r.fields
    q, s = f.first("question", default=""), f.first("solution", default="")
    empty = (F.length(q) == 0) | (F.length(s) == 0)
    r.effects.drop(empty, "missing_problem_or_solution")
    r.effects.review(~empty & F.rlike(F.concat(q, F.lit("\n"), s), F.lit(V.IMAGE_REFERENCE)) & ~f.truthy("image_text"), "missing_multimodal_context")


def math_answer(r: Row) -> None:
    f = r.fields
    s = f.first("solution", default="")
    ok = f.boolean("verified")
    r.effects.review(F.length(s) < 32, "solution_too_short")
    r.effects.review(~F.rlike(s, F.lit(V.ANSWER_SIGNAL)) & ~f.truthy("answer"), "missing_final_answer_signal")
    r.effects.bucket("verified", F.when(ok, "verified").when(~ok, "failed").otherwise("unknown"))
    r.effects.review(F.coalesce(~ok, F.lit(False)), "verifier_failed")


def math_buckets(r: Row) -> None:
    f = r.fields
    r.effects.bucket("form", F.coalesce(f.shown("form"), F.when(f.truthy("chapter"), "textbook").otherwise("qa")))
    r.effects.bucket("difficulty", f.first("difficulty", default="unknown"))
    r.effects.bucket("domain", f.first("domain", "subject", default="math"))


# --- reasoning --------------------------------------------------------------


def reasoning_schema(r: Row) -> None:
    f = r.fields
    copy_absent(f, "prompt", "problem")
    copy_absent(f, "response", "reasoning")
    pair = both(f, "problem", "reasoning")
    r.parts += [(pair & f.string("final_answer").isNotNull(), ("problem", "reasoning", "final_answer")), (pair, ("problem", "reasoning"))]


def control_artifacts(r: Row) -> None:
    r.effects.review(F.rlike(r.text, F.lit(V.CONTROL_ARTIFACT)), "control_or_prompt_artifact")


def reasoning_signal(r: Row) -> None:
    f = r.fields
    t = f.first("reasoning", default="")
    r.effects.drop(F.length(t) == 0, "missing_reasoning")
    r.effects.review((F.length(t) > 0) & ((F.length(t) < 64) | ~F.rlike(t, F.lit(V.REASONING_SIGNAL))), "weak_reasoning_signal")
    r.effects.review(~f.truthy("final_answer") & ~f.truthy("answer"), "missing_final_answer")


def reasoning_buckets(r: Row) -> None:
    f = r.fields
    r.effects.bucket("origin", F.when(f.truthy("teacher_model"), "teacher_rewrite").otherwise(f.first("origin", default="raw")))
    r.effects.bucket("domain", f.first("domain", "source_group", default="general"))
    r.effects.bucket("verified", F.when(f.truthy("verified"), "verified").otherwise("unverified"))
    r.effects.renewed["lineage_hash"] = F.coalesce(f.string("lineage_hash"), f.shown("source_row_hash"))


PREFIX: tuple[tuple[str, Step | None], ...] = (
    ("normalize_schema_text", None), ("validate_basic_integrity", basic_integrity), ("validate_provenance", provenance), ("scan_sensitive_content", sensitive_content),
)
SUFFIX = ("apply_quality_policy", "exact_deduplicate", "near_deduplicate", "estimate_tokens_and_length_bucket", "finalize_quality_bucket")
CATEGORY_STEPS: dict[str, tuple[tuple[str, Step], ...]] = {
    "web": (("normalize_web_schema", web_schema), ("filter_web_boilerplate", web_boilerplate), ("validate_web_qa", web_qa), ("bucket_web", web_buckets)),
    "code": (("normalize_code_schema", code_schema), ("classify_code_language", code_language), ("filter_non_source_assets", code_assets), ("validate_code_signal", code_signal), ("bucket_code_task", code_task)),
    "agentic": (("normalize_agentic_schema", agentic_schema), ("validate_role_order", role_order), ("validate_tool_call_pairs", tool_pairs), ("detect_trajectory_outcome", outcome), ("bucket_agentic", tool_family)),
    "instruction": (("normalize_instruction_schema", instruction_schema), ("validate_instruction_pair", instruction_pair), ("filter_instruction_templates", instruction_templates), ("bucket_instruction", instruction_buckets)),
    "math": (("normalize_math_schema", math_schema), ("validate_problem_solution", problem_solution), ("validate_math_answer_signal", math_answer), ("bucket_math", math_buckets)),
    "reasoning": (("normalize_reasoning_schema", reasoning_schema), ("detect_control_artifacts", control_artifacts), ("validate_reasoning_signal", reasoning_signal), ("bucket_reasoning", reasoning_buckets)),
    "general_text": (),
}


def register_step(category: str, name: str, step: Step) -> None:
    """Add a step behind the category's own; a new category begins with a schema step."""
    CATEGORY_STEPS[category] = (*CATEGORY_STEPS.get(category, ()), (name, step))
