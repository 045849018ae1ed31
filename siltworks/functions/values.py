"""Values that results depend on: patterns, word lists, defaults and token sets."""

# These must be as they are for results to agree with other
# implementations of the same cleaning rules.
SECRET = r"""(?i)(?:api[_-]?key|secret|password|access[_-]?token)\s*[:=]\s*["']?[A-Za-z0-9_\-/.]{12,}"""
BOILERPLATE = r"(?i)(?:cookie policy|accept all cookies|privacy policy|sign in|subscribe now)"
UNKNOWN_ANSWER = r"(?i)^\s*(?:unknown|n/?a|i don'?t know|无法回答|不知道)\s*[.!。！]?$"
GENERATED_CODE = r"(?i)(?:generated file|do not edit|auto[- ]generated)"
CODE_SIGNAL = r"[{}();]|\b(?:def|class|function|import|package|SELECT|FROM)\b"
CANNED_RESPONSE = r"(?i)(?:as an ai language model|i cannot assist with|here is the requested response)"
IMAGE_REFERENCE = r"(?i)(?:<img|\.(?:png|jpg|jpeg|gif|svg)\b|\\includegraphics|see (?:the )?figure)"
ANSWER_SIGNAL = r"(?i)(?:final answer|answer\s*:|therefore|thus|\\boxed\{|答案|所以)"
CONTROL_ARTIFACT = r"(?is)<\|(?:system|assistant|user|endoftext)[^>]*\|>|\[system prompt\]|api[_ ]error"
REASONING_SIGNAL = r"(?i)(?:because|therefore|first,|step \d+|we need to|由于|因此|首先|步骤)"
FAILURE_MARKERS = ("exit due to", "permission denied", "tool error", "timed out")
SUCCESS_MARKERS = ("submitted", "tests passed", "task completed", "success")
DENIED_PATH_PARTS = ("node_modules/", "vendor/", ".min.js", ".map")
CALL_ROLES = ("assistant_tool", "tool_call")
OBSERVATION_ROLES = ("tool", "tool_response", "observation")
CONTEXT_LENGTHS = (4096, 16384, 65536)
MIN_CHARS, MAX_CHARS = 16, 2_000_000
IGNORE_INDEX = -100
TEXT_COLUMNS = ("text", "content", "body", "raw_content")
KEPT_PARQUET_COLUMNS = ("id", "source", "source_id", "url", "score", "quality_mean", "quality_score")
END_OF_TEXT, UNKNOWN_TOKEN = "<|endoftext|>", "<|unk|>"
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
THINK_START, THINK_END = "<|think_start|>", "<|think_end|>"
ROLE_TOKENS = ("system", "user", "assistant", "tool")
SPECIAL_TOKENS = (END_OF_TEXT, UNKNOWN_TOKEN, TURN_START, TURN_END, *ROLE_TOKENS, THINK_START, THINK_END)
MINIMAL_SPECIAL_TOKENS = (END_OF_TEXT, UNKNOWN_TOKEN)
QUALITY_POLICIES = {
    "web": {"score_field": "quality_mean", "keep_min": 4.0, "review_min": 3.0, "require_score": False},
    "math": {"score_field": "quality_score", "keep_min": 0.8, "review_min": 0.5, "hard_error_field": "hard_error_score", "hard_error_max": 3},
}
# End of the fixed values.

STAGES = ("pretrain", "midtrain", "posttrain", "sft")
CATEGORIES = ("code", "web", "agentic", "instruction", "math", "reasoning", "general_text")
DECISIONS = ("keep", "review", "drop")
KEEP, REVIEW, DROP = 0, 1, 2
