import math
import re
from collections import Counter

from chronomart.llm import quality_rules as rules
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import documents, frame, words

SYMBOL = re.compile(r"[#*$%&|<>]")


def base(text):
    text = text or ""
    ws = words(text)
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    repeat = set()
    for i in range(len(ws) - 7):
        if seen[tuple(ws[i : i + 8])] > 1:
            repeat.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(ws) < 20 or 100 * len(repeat) > 30 * len(ws)
    return (len(ws), sum(map(len, ws)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), len(repeat), failed)


def histograms(text, lang):
    text = text or ""
    n, chars, symbols, *_ = base(text)
    letters = sum(c.isalpha() for c in text)
    upper = sum(c.isupper() for c in text)
    digits = sum(c in "0123456789" for c in text)
    spaces = len(text) - chars
    classes = [letters - upper, upper, digits, spaces, symbols, max(0, len(text) - letters - digits - spaces - symbols)]
    if lang not in rules.COMMON_WORDS:
        return classes, None
    plain = Counter(w for w in re.split(r"[\W\d_]+", text.lower()) if w)
    common = [plain[w] for w in rules.COMMON_WORDS[lang]]
    return classes, [*common, max(0, n - sum(common))]


def distance(p, q):
    if p is None or q is None or not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = 0.0
    for a, b in zip(p, q):
        total += sum(x * math.log2(x / ((a + b) / 2)) for x in (a, b) if x > 0) / 2
    return math.sqrt(max(total, 0.0))


def brute(rows):
    sums = {}
    for text, lang in rows:
        classes, common = histograms(text, lang)
        if common is not None and not base(text)[-1]:
            old = sums.setdefault(lang, ([0] * 6, [0] * len(common)))
            sums[lang] = tuple([x + y for x, y in zip(o, new)] for o, new in zip(old, (classes, common)))
    out = []
    for text, lang in rows:
        b, (classes, common) = base(text), histograms(text, lang)
        far_c, far_w = (distance(x, y) for x, y in zip((classes, common), sums.get(lang, (None, None))))
        far = far_c is not None and len(text or "") >= rules.MIN_CHARS and far_c > rules.MAX_CLASS_DISTANCE
        if far_w is not None and b[0] >= rules.MIN_WORDS:
            far |= far_w > rules.MAX_WORD_DISTANCE + rules.WORD_NOISE / math.sqrt(b[0])
        out.append((*b, not b[-1] and not far, far_c, far_w))
    return out


def compare(found, rows):
    expected = [(k, *b) for (k, _, _), b in zip(rows, brute([(t, g) for _, t, g in rows]))]
    found, expected = sorted(found, key=lambda r: str(r[:7])), sorted(expected, key=lambda r: str(r[:7]))
    assert [r[:8] for r in found] == [r[:8] for r in expected]
    for ours, theirs in zip(found, expected):
        for x, y in zip(ours[8:], theirs[8:]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-6)


def test_awkward_documents(spark, tmp_path):
    rows = documents()
    loop = " ".join(f"l{i}" for i in range(11))
    rows += [(8000, f"{loop} {loop} of the end", "fr", "s", 1), (8001, "same line\n" * 9 + "a" * 300, None, "s", 1),
             (8002, " ".join(f"#{i}$" for i in range(400)), "en", "s", 1), (8003, "w " * 19, "es", "s", 1),
             (8004, "\x85 é " * 40 + "\x0bx", "fr", "s", 1)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op8_quality_rules"](spark, str(tmp_path)).collect()]
    compare(found, [r[:3] for r in rows])


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    compare([tuple(r) for r in QUERIES["op8_quality_rules"](spark, sf).collect()], rows)


def test_kept_documents_have_their_own_columns(spark):
    docs = frame(spark, documents()).selectExpr("*", "5 as n_words", "6 as kept")
    kept = rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count() and kept.where("n_words <> 5 or kept <> 6").count() == 0
    assert rules.kept_documents(docs.limit(0)).count() == 0


def test_labelled_documents(spark):
    """Documents labelled good stay; of those labelled bad, long enough and past the base rules, half go."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_quality_rules"](spark, sf).collect() if r.doc_id in labels]
    good = [r for r in rows if labels[r.doc_id] == 1 and not r.base_failed]
    bad = [r for r in rows if labels[r.doc_id] == 0 and not r.base_failed and r.n_words >= rules.MIN_WORDS]
    assert all(r.kept for r in good)
    assert sum(not r.kept for r in bad) >= 0.4 * len(bad)


def test_listed_words_beside_long_ones(spark):
    """Words longer than any listed one are set aside before listed words are counted, in bytes."""
    texts = [("für unglaublichwerden werden Unglaublich werden,für den denden é", "de"), ("más másmásmás más y y yyyyyyy y", "es")]
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(texts)], "doc_id long, text string, lang string")
    measured = rules.measures(docs)
    found = {r.doc_id: r.common for r in measured.collect()}
    for i, (text, lang) in enumerate(texts):
        assert found[i] == histograms(text, lang)[1][:-1]
    # The listed words are sought in the shortened text, and nothing counts its characters once a word.
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and f"{{{rules.LONGEST + 1},}}" in plan
