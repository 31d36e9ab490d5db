"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def edited(rng, text, edits):
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


def documents(seed=3):
    """Rows (doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    passage = prose(rng, 55)
    texts = [*base]
    for text in base[:6]:
        texts += [edited(rng, text, k) for k in (0, 1, 2, 3, 6, 12)]
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 25)}" for _ in range(8)]
    texts += ["tie " * 90, "tie " * 40, "a b c", "a b c", "A b\tc", "é ü one\x85two", prose(rng, 12_000)]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[6], (None, base[0], None, None, None), (7_000, None, "en", "s", 0), (7_001, "", "xx", "s", 0),
             (7_002, " \n\t ", "de", "s", 4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
