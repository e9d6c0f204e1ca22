"""Small tables with every awkward case: nulls, empty and long texts, ties, repeats, clashing extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, fp string, node long, base string"


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source); the extra columns clash with the operators' own names."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", f"src{(r[0] or 0) % 3}")), len(r[1] or ""), 0.1, 7, "x", 1, "b") for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, words):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in ("ta", "mi", "so", "re") for b in ("ka", "lo", "né", "du") for c in ("st", "r", "m.", "n,", "")]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


def awkward():
    long_text = prose(1, 30_000)
    return [
        (5, prose(2, 40)), (1, "short one"), (None, "no id at all"), (None, "no id at all"), (3, None), (4, ""), (8, "   \n\t "), (9, long_text),
        (9, long_text), (10, "a\n\nb  c\t d e don't I'll <|endoftext|> <s> ▁x"), (11, "漢字かな 🙂🙂 é \x1c Σας"), (12, "x" * 3000), (13, prose(3, 300)), (14, prose(3, 300)),
    ]
