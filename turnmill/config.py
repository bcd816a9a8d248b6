"""Parameters, vocabulary, labels and table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Texts and numbers that results depend on.
# ---------------------------------------------------------------------------

SYSTEM_PROMPT = (
    "You are a helpful customer support assistant. "
    "Answer clearly, politely, and concisely. "
    "If needed, ask one short follow-up question."
)

# Markers that always become the same text.
STATIC_MARKERS = {
    "Customer Support Phone Number": "1-800-555-0199",
    "Customer Support Email": "support@company.com",
    "Customer Support Hours": "Monday-Friday, 9 AM to 6 PM EST",
    "Website URL": "www.company.com/support",
    "App": "our mobile app",
    "App Name": "our mobile app",
    "Company": "our company",
    "Company Name": "our company",
    "Live Chat": "our live chat on the website",
    "Customer Support Channel": "our customer support page",
    "Customer Account Page": "your account settings page",
    "Password Reset URL": "www.company.com/reset-password",
    "Subscription Plan": "your current plan",
    "Billing Address": "your billing address on file",
    "Shipping Address": "your shipping address on file",
    "Currency Symbol": "$",
    "Warranty Period": "12 months",
}

# Markers that become a prefix and a number drawn from [low, high].
NUMBER_MARKERS = {
    "Order Number": ("ORD-", 100000, 999999),
    "Tracking Number": ("TRK-", 1000000, 9999999),
    "Invoice Number": ("INV-", 10000, 99999),
    "Account Number": ("ACC-", 10000, 99999),
}

# Markers that become one of a few texts.
POOL_MARKERS = {
    "Delivery City": (
        "New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
        "London", "Toronto", "Mumbai", "Sydney", "Berlin",
    ),
    "Product Name": ("the product", "your item", "the ordered product"),
    "Account Email": ("your registered email address",),
    "Refund Amount": ("$9.99", "$14.99", "$24.99", "$39.99", "$49.99", "$79.99"),
    "Delivery Date": (
        "within 3-5 business days", "within 5-7 business days",
        "by the estimated delivery date",
    ),
    "Promo Code": ("SAVE10", "WELCOME20", "LOYALTY15", "FIRSTORDER"),
}

LEFTOVER_PATTERN = r"\{\{[^}]+\}\}"
LEFTOVER_TEXT = "your reference number"

# System text of the chat format when a conversation brings none.
DEFAULT_SYSTEM_TEXT = (
    "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
)
TOOLS_INTRO = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query."
    "\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\nFor each function call, return a json object with function name and"
    " arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call><|im_end|>\n'
)

# Metric keys in report order, and the digits each is rounded to.
METRIC_DIGITS = {
    "rouge1": 4,
    "rouge2": 4,
    "rougeL": 4,
    "rougeLsum": 4,
    "bleu": 4,
    "bertscore_f1": 4,
    "exact_match": 4,
    "approx_perplexity": 2,
    "avg_pred_length_words": 1,
    "avg_ref_length_words": 1,
    "avg_generation_time_sec": 3,
}

# Metrics of the printed summary (two keys are stored but not printed).
SUMMARY_LABELS = {
    "rouge1": "ROUGE-1",
    "rouge2": "ROUGE-2",
    "rougeL": "ROUGE-L",
    "bleu": "BLEU",
    "bertscore_f1": "BERTScore F1",
    "exact_match": "Exact Match",
    "approx_perplexity": "Approx Perplexity (low=better)",
    "avg_pred_length_words": "Avg Response Length (words)",
    "avg_generation_time_sec": "Avg Generation Time (sec)",
}

# Executive table: label, digits shown (-1: as stored), whether a change is shown.
EXECUTIVE_ROWS = {
    "rouge1": ("ROUGE-1", 4, True),
    "rouge2": ("ROUGE-2", 4, True),
    "rougeL": ("ROUGE-L", 4, True),
    "bleu": ("BLEU", 4, True),
    "bertscore_f1": ("BERTScore F1", 4, True),
    "exact_match": ("Exact Match", 4, True),
    "approx_perplexity": ("Approx Perplexity", 2, True),
    "avg_pred_length_words": ("Avg Response Length (words)", -1, False),
    "avg_generation_time_sec": ("Avg Generation Time (sec)", -1, False),
}

# Reference guide: label, meaning, range, threshold, and whether higher is better.
METRIC_GUIDE = {
    "rouge1": ("ROUGE-1", "Unigram (word) overlap", "0–1", 0.30, True),
    "rouge2": ("ROUGE-2", "Bigram overlap", "0–1", 0.10, True),
    "rougeL": ("ROUGE-L", "Longest common subsequence", "0–1", 0.25, True),
    "bleu": ("BLEU", "Precision n-gram match", "0–1", 0.05, True),
    "bertscore_f1": (
        "BERTScore F1", "Semantic similarity (embedding-level)", "0–1", 0.85, True,
    ),
    "exact_match": ("Exact Match", "Perfect string equality", "0–1", 0.01, True),
    "approx_perplexity": (
        "Perplexity", "How 'surprised' the model is (lower = better)", "1–∞", 50.0, False,
    ),
}

COMPARISON_KEYS = ("rouge1", "rouge2", "rougeL", "bleu", "exact_match")
ROUGE_KEYS = ("rouge1", "rouge2", "rougeL", "rougeLsum")
IMPROVEMENT_KEYS = ("rouge1", "rouge2", "rougeL", "bleu", "bertscore_f1", "exact_match")

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CurateParams:
    """Knobs of the curation plan."""

    system_prompt: str = SYSTEM_PROMPT
    seed: int = 42
    split_seed: int = 43
    min_instruction_chars: int = 5
    max_total_chars: int = 950
    holdout_share: float = 0.2
    test_share: float = 0.5
    static_markers: dict = field(default_factory=lambda: dict(STATIC_MARKERS))
    number_markers: dict = field(default_factory=lambda: dict(NUMBER_MARKERS))
    pool_markers: dict = field(default_factory=lambda: dict(POOL_MARKERS))


@dataclass(frozen=True)
class TrainParams:
    """Sizes that decide how many optimiser steps a run takes."""

    train_cap: int = 5000
    validation_cap: int = 1000
    batch_size: int = 1
    accumulation: int = 16


EVAL_SAMPLES = 50
LONG_ANSWER_CHARS = 800
EXCERPT_CHARS = 300
PREVIEW_CHARS = 120
EXAMPLE_ROWS = 8
HISTOGRAM_BINS = 34
MIN_GROUP_ROWS = 2

MODELS = ("baseline", "fine_tuned")

RAW_SCHEMA = T.StructType([
    T.StructField("row_id", T.StringType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("intent", T.StringType()),
    T.StructField("category", T.StringType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("prompt", "reference", "baseline", "fine_tuned", "intent", "category")
])

METRIC_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

TRAIN_LOG_SCHEMA = T.StructType([T.StructField("step", T.LongType())] + [
    T.StructField(name, T.DoubleType())
    for name in (
        "loss", "grad_norm", "learning_rate", "entropy", "num_tokens",
        "mean_token_accuracy", "epoch",
        "eval_loss", "eval_runtime", "eval_samples_per_second",
        "eval_steps_per_second", "eval_entropy", "eval_num_tokens",
        "eval_mean_token_accuracy",
        "train_runtime", "train_samples_per_second", "train_steps_per_second",
        "total_flos", "train_loss",
    )
])
