import random

from chronomart.llm import line_dedup
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import documents, edited, frame, prose


def grams(line):
    out, i, line = set(), 0, line.lower()
    while i < len(line):
        if line[i] not in " \t\n\x0b\f\r":
            out.add(line[i : i + line_dedup.SHINGLE])
            while i < len(line) and line[i] not in " \t\n\x0b\f\r":
                i += 1
        else:
            i += 1
    return out


def brute(rows):
    """doc_id -> lines that stay, over rows with different ids."""
    places = [(k, at, line) for k, text in sorted(rows) for at, line in enumerate((text or "").split("\n"))
              if len(line) >= line_dedup.MIN_CHARS and grams(line)]
    sets = [grams(line) for *_, line in places]
    root = list(range(len(places)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(places)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= line_dedup.PERCENT * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    gone = {places[i][:2] for i in range(len(places)) if find(i) != i}
    return {k: [x for at, x in enumerate((t or "").split("\n")) if (k, at) not in gone] for k, t in rows}


def alike_lines(seed=4):
    rng = random.Random(seed)
    lines = [prose(rng, rng.randint(6, 40)) for _ in range(25)]
    rows = []
    for i in range(40):
        some = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(lines)
            some.append(edited(rng, line, rng.choice([0, 0, 1, 2])) if rng.random() < 0.8 else prose(rng, 12))
            if rng.random() < 0.2:
                some.append(rng.choice(["", "short one", line.upper()]))
        rows.append((i, "\n".join(some)))
    return rows


def test_alike_lines(spark):
    rows = alike_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    found = line_dedup.keep_one_of_alike(docs).collect()
    for r in found:
        assert r.text.split("\n") == expected[r.doc_id] or not expected[r.doc_id] and r.text == ""
        assert r.n_lines - r.n_removed == len(expected[r.doc_id])
    assert len(found) == len(rows)


def test_awkward_documents(spark, tmp_path):
    rows = documents()
    rows += [(9000 + i, "a licence line that many documents share, word for word\n" + "é" * i, "en", "s", 0) for i in range(50)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = frame(spark, rows).selectExpr("*", "3 as n_removed", "4 as component")
    found = line_dedup.keep_one_of_alike(docs)
    assert found.columns == [*[c for c in docs.columns if c != "n_removed"], "n_lines", "n_removed"]
    expected = brute({r[0]: r[:2] for r in rows if r[0] is not None}.values())
    for r in found.collect():
        if r.doc_id is None:
            assert r.n_removed == 0 and r.text == next(x[1] for x in rows if x[0] is None)
        elif next(x[1] for x in rows if x[0] == r.doc_id) is None:
            assert (r.text, r.n_lines, r.n_removed) == (None, 0, 0)
        else:
            assert r.text == "\n".join(expected[r.doc_id])
            assert r.n_lines - r.n_removed == len(expected[r.doc_id])
    assert QUERIES["op7_line_dedup"](spark, str(tmp_path)).count() == len(rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.keep_one_of_alike(docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(alike_lines()[:5], "doc_id long, text string")
    plan = line_dedup.keep_one_of_alike(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_bands_find_alike_lines_at_the_threshold(spark):
    """Recall of the bands on pairs of similarity 0.8 to 0.85."""
    from pyspark.sql import functions as F

    rng, pairs = random.Random(8), []
    while len(pairs) < 400:
        a = prose(rng, 30)
        b = edited(rng, a, 2)
        common = len(grams(a) & grams(b))
        if 0.8 <= common / (len(grams(a)) + len(grams(b)) - common) <= 0.85:
            pairs.append((2 * len(pairs), a))
            pairs.append((2 * len(pairs) - 1, b))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    signed = line_dedup.signatures(line_dedup.lines_of(docs, "doc_id", "text"))
    rows = {r.doc: set(r._keys) for r in signed.select(F.col("_first._doc.key").alias("doc"), "_keys").collect()}
    met = sum(bool(rows[pairs[i][0]] & rows[pairs[i + 1][0]]) for i in range(0, len(pairs), 2))
    assert met >= 0.97 * (len(pairs) // 2)


def all_grams(line):
    line = line.lower()
    return {line[i : i + line_dedup.SHINGLE] for i in range(max(1, len(line) - line_dedup.SHINGLE + 1))}


def whole_brute(rows):
    """doc_id -> lines that stay, by all shingles of all lines that are not blank."""
    places = [(k, at, line) for k, text in sorted(rows) for at, line in enumerate(text.split("\n")) if line.strip()]
    sets, group = [all_grams(line) for *_, line in places], list(range(len(places)))
    for i in range(len(places)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= line_dedup.PERCENT * (len(sets[i]) + len(sets[j]) - common) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    gone = {places[i][:2] for i in range(len(places)) if group[i] != i}
    return {k: [x for at, x in enumerate(t.split("\n")) if (k, at) not in gone] for k, t in rows}


def kept_whole(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.text.split("\n") if r.text else [] for r in line_dedup.keep_one_of_alike(docs, whole=True).collect()}


def test_all_of_a_line_is_read(spark):
    long = "https://example.org/" + "".join(random.Random(3).choices("abcdefghij", k=120))
    rows = [(1, "https://example.org/a/first"), (2, "https://example.org/b/other"), (3, long), (4, long[:-1] + "z"),
            (5, "今日は天気がとても良いので散歩に行きました"), (6, "今日は天気がとても悪いので家で本を読みました")]
    kept = kept_whole(spark, rows)
    assert kept == {k: [] if k == 4 else [t] for k, t in rows}
    rows = alike_lines(9)
    expected = whole_brute(rows)
    assert kept_whole(spark, rows) == {k: [] if v == [""] else v for k, v in expected.items()}


def test_short_lines_that_repeat_go(spark):
    rows = [(1, "Home\n\nAbout us"), (2, "About us\n\nhome\nb"), (3, "Home\n  \nc")]
    assert kept_whole(spark, rows) == {1: ["Home", "", "About us"], 2: ["", "b"], 3: ["  ", "c"]}


def test_alike_lines_that_share_one_band_meet(spark, monkeypatch):
    """One key holds everything, so its least line is unlike the alike ones."""
    from pyspark.sql import functions as F

    signatures = line_dedup.signatures
    monkeypatch.setattr(line_dedup, "TILE", 4)
    monkeypatch.setattr(
        line_dedup, "signatures",
        lambda *a: signatures(*a).withColumn("_keys", F.concat(F.array(F.lit(1).cast("long")), *[F.array(F.xxhash64(F.lit(i), "_h1")) for i in range(4)])),
    )
    rng = random.Random(5)
    lead = prose(rng, 20)
    rows = [(i, lead) for i in range(5)]
    for i in range(10, 30, 2):
        line = prose(rng, 20)
        rows += [(i, line), (i + 1, line + ".")]
    kept = kept_whole(spark, rows)
    assert sorted(k for k, v in kept.items() if v) == [0, *range(10, 30, 2)]


def test_rows_of_one_key_with_different_texts(spark):
    first = "dup dup dup dup\nother words one"
    second = "a unique line that nobody else has\nquite another ending\ndup dup dup dup"
    rows = [(1, first, 7), (1, second, 8), (1, first, 9), (2, "dup dup dup dup\nlast", 7), (None, first, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _doc int")
    found = sorted(((r.doc_id or 0, r._doc, r.text, r.n_removed) for r in line_dedup.keep_one_of_alike(docs, whole=True).collect()))
    assert found[0] == (0, 7, first, 0) and found[-1] == (2, 7, "last", 1)
    by = {r[1]: r for r in found[1:-1]}
    assert by[7][2] == by[9][2]
    # Of the two texts under key 1 one keeps the line they share; nothing else goes.
    assert {(by[7][2], by[8][2])} <= {(first, second.rpartition("\n")[0]), ("other words one", second)}


def test_bitmaps_bound_the_similarity(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    lines = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    lines += [edited(rng, line, rng.choice([0, 1, 2, 3])) for line in lines for _ in range(3)] + ["", "é", "ab" * 5000]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, _line string").withColumn("_g", line_dedup.grams(F.col("_line"), True))
    rows = df.select("id", F.size("_g").alias("_n"), *line_dedup.bitmap(F.col("_g")), "_g")
    sides = [rows.toDF(*[c if c == "_g" + e else f"{c}_{e}" for c in rows.columns]) for e in "ab"]
    met = sides[0].join(sides[1], F.col("id_a") < F.col("id_b"))
    common = F.size(F.array_intersect("_g_a", "_g_b"))
    alike = (100 + line_dedup.PERCENT) * common >= line_dedup.PERCENT * (F.col("_n_a") + F.col("_n_b"))
    counts = met.select(alike.alias("alike"), line_dedup._possible("_a", "_b").alias("may")).groupBy("alike", "may").count().collect()
    counts = {(r.alike, r.may): r["count"] for r in counts}
    assert (True, False) not in counts and counts[True, True] > 100 and counts[False, False] > 50 * counts.get((False, True), 0)


def test_bands_of_whole_lines_find_alike_lines(spark):
    """Recall of the bands, as the query and the pipeline use them, on pairs of similarity 0.8 to 0.85."""
    from pyspark.sql import functions as F

    rng, pairs = random.Random(18), []
    while len(pairs) < 600:
        a = prose(rng, 40)
        b = edited(rng, a, rng.choice([1, 2, 3]))
        common = len(all_grams(a) & all_grams(b))
        if 0.8 <= common / (len(all_grams(a)) + len(all_grams(b)) - common) <= 0.85:
            pairs += [(len(pairs), a), (len(pairs) + 1, b)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    signed = line_dedup.signatures(line_dedup.lines_of(docs, "doc_id", "text", True), True)
    rows = {r.doc: set(r._keys) for r in signed.select(F.col("_first._doc.key").alias("doc"), "_keys").collect()}
    met = sum(bool(rows[i] & rows[i + 1]) for i in range(0, len(pairs), 2))
    assert met >= 0.98 * (len(pairs) // 2)
