"""Documents with everything a table may hold, and helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string, rank int"
rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else r.choice(VOCABULARY) + "x" for w in text.split(" "))


def odd_texts():
    """Null, empty, blank, short, long, repeated, multi-byte and line-heavy texts."""
    base, long = prose(120, 1), prose(30000, 2)
    passage = prose(60, 3)
    return [
        None, "", "   ", "\n\n\n", "one", "One two three four", "one two three four", "ONE TWO three four five six",
        base, base, edited(base, 0.01, 4), edited(base, 0.3, 5), long, edited(long, 0.005, 6),
        f"{prose(80, 7)}\n{passage}\n{prose(50, 8)}", f"{prose(10, 9)} {passage}", passage, passage * 3,
        "ab" * 300, "a" * 5000, "日本語のテキスト " * 30, "é😀ü " * 40, "tab\tand\x0bvertical\x0cfeed\r\n" * 20,
        "same line here\n" * 30, "### $$$ %%% | < > & *" * 5, "\u0000\u0001 odd ▁ bytes",
    ]


def documents(spark, texts=None):
    texts = odd_texts() if texts is None else texts
    langs = ["en", None, "de"]
    rows = [(i, t, langs[i % 3], None if i % 4 else "s", None if t is None else len(t), "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
