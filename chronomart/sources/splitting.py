"""Records of JSON envelopes of any size: one document is read by many tasks.

Spark's text reader cuts a file at every ``}``, so each split of the file gives pieces that end with a closing
brace, in order. Some pieces in a row, a run, are put together to one row, so that all that follows is done once a run
and not once a piece. What a run means depends on all before it in its file, but only through sums, which are carried
from run to run (a parallel prefix):

1. the quotes before it, odd inside a string (escaped characters are left out first);
2. the brackets opened and not closed before it, outside strings: its depth;
3. the last container opened at depth 1, which is the array of records or another one;
4. the records ended before it: a record ends where a brace closes back to depth 2 within that array.

A run that does not leave the array of records is cut into them by one pattern. Any other one (the beginning and end of
the array, elements that are no objects, very deep nesting) is scanned piece by piece. Only a record that reaches over the
border of two runs is gathered from both. No row is longer than a run or a record and what stands before it.

A document whose quotes or brackets do not match adds no rows, as with the whole-document reader; see
:func:`unreadable_files`. Compressed files cannot be split: give them to the whole-document reader. Records are
objects; an element of another kind adds no row. A record that is no JSON by itself has nulls in all fields.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.session import materialise
from chronomart.sources.envelopes import whole_records

#: A piece's place: its file, the split it was read in (and a run of pieces there), and its order there.
FILE, SPLIT, AT = "_file", "_split", "_at"
#: Pieces in a run, as a power of two; a run never reaches over a split.
RUN_BITS = 10
#: Stands in a text's brackets for the opening of the array of records; no bracket of JSON.
RECORDS = "<"
#: Containers within containers that a pattern follows; deeper ones are counted one by one.
DEEP = 16

# Patterns. The loops are possessive, so they neither go back nor use the stack. A container's ends are not told apart.
# A backslash belongs to what follows it in a string and, though that is no JSON, outside; only a brace is one all the same.
_PLAIN, _IN_STRING = r'[^"{}\[\]\\]*+(?:\\[^}][^"{}\[\]\\]*+)*+', r'[^"\\]*+(?:\\.[^"\\]*+)*+'


def _nested(opening: str, closing: str, plain: str, more: str) -> str:
    """A container that holds ``plain``, ``more`` and up to ``DEEP`` containers one in the other."""
    found = f"{opening}{plain}(?:{more}{plain})*+{closing}"
    for _ in range(DEEP):
        found = f"{opening}{plain}(?:(?:{more}|{found}){plain})*+{closing}"
    return found


_WITHIN = rf'{_PLAIN}(?:(?:"{_IN_STRING}"|' + _nested(r"[{\[]", r"[}\]]", _PLAIN, f'"{_IN_STRING}"') + rf"){_PLAIN})*+"
#: An object or the beginning of one that does not end, as group 1; or anything else with structure, and all after it.
_OBJECT = rf'(?s)(\{{{_WITHIN}\}}|\{{{_WITHIN}(?:[{{\[]{_WITHIN})*+(?:"{_IN_STRING})?+\z)|["{{}}\[\]\\].*+'
_BALANCED = _nested(rf"[{{{RECORDS}]", r"\}", "", "(?!)")


def _pieces(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """The text before each ``}`` of every file, with its place."""
    read = spark.read.option("lineSep", "}").option("pathGlobFilter", glob).text(path)
    at = F.monotonically_increasing_id()
    return read.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("begin"),
        F.shiftright(at, RUN_BITS).alias("run"),
        at.alias(AT),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )


def _staged(spark: SparkSession, path: str | list[str], array: str, glob: str) -> DataFrame:
    """The runs with what is in them, written once: a second scan might cut the files elsewhere."""
    pieces = F.sort_array(F.collect_list(F.struct(AT, "value"))).alias("pieces")
    # Numbers go on from split to split in a task. Of a run's few splits a hash holds as key, which costs less than names.
    split = F.xxhash64(FILE, "begin").alias("split")
    same = [F.first(c).alias(c) for c in (FILE, "begin", "size")]
    runs = _pieces(spark, path, glob).groupBy("run", split).agg(pieces, *same)
    last = F.element_at("pieces", -1)["value"]
    runs = runs.select(
        FILE,
        F.struct("begin", "run").alias(SPLIT),
        "size",
        (F.trim(F.translate(last, "\t\r\n", "   ")) == "").alias("blank"),
        F.concat(F.array_join(F.transform("pieces", lambda p: p["value"]), "}"), F.lit("}")).alias("text"),
    )
    quotes, out, inn = _structure(F.col("text"), array)
    short = {"out": F.regexp_replace(out, _BALANCED, ""), "in": F.regexp_replace(inn, _BALANCED, "")}
    return materialise(runs.withColumns({"bytes": F.octet_length("text"), "quotes": quotes, **short}), "runs")


def _count(text: Column, character: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(character), F.lit("")))


def _structure(text: Column, array: str) -> tuple[Column, Column, Column]:
    """Of a text: its quotes, and its opening and closing brackets, as braces, if it begins outside or inside a string."""
    escaped = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    opening = rf'"{re.escape(array)}"\s*:\s*\['

    def other(string: str) -> str:
        return rf'(?:[^"{{}}\[\]\\]|\\[^}}]){_PLAIN}(?:{string}{_PLAIN})*+|(?:{string}{_PLAIN})++'

    string = rf'"{_IN_STRING}"?+'
    marking = rf"(?s){other(f'(?!{opening}){string}')}|({opening})"

    def brackets(outside: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(outside, marking, "$1"), opening, RECORDS)
        named = F.when(outside.contains(f'"{array}"'), marked).otherwise(F.regexp_replace(outside, f"(?s){other(string)}", ""))
        return F.translate(named, "[]\\", "{}")

    return _count(escaped, '"'), brackets(text), brackets(F.concat(F.lit('"}'), text))


def _folded(brackets: Column, depth: Column) -> Column:
    """From ``depth`` on: the depth after the brackets, the least on the way, and the kind of the last container opened
    at depth 1: 'r' for the array of records, 'o' for any other."""
    state = F.struct(depth.alias("d"), depth.alias("low"), F.lit(None).cast("string").alias("kind"))

    def fold(s: Column, c: Column) -> Column:
        d = s["d"] + F.when(c == "}", -1).otherwise(1)
        kind = F.when((s["d"] == 1) & (c == RECORDS), "r").when((s["d"] == 1) & (c != "}"), "o").otherwise(s["kind"])
        return F.struct(d.alias("d"), F.least(s["low"], d).alias("low"), kind.alias("kind"))

    return F.aggregate(F.filter(F.split(brackets, ""), lambda c: c != ""), state, fold)


def _opened(brackets: str) -> Column:
    return F.length(brackets) - 2 * _count(F.col(brackets), "}")


def _starts(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each run starts from and comes to, and for each file whether it can be read. The text takes no part."""
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    rows = runs.drop("text").withColumn("inside0", so_far("quotes") % 2 == 1)
    rows = rows.withColumn("brackets", F.when(F.col("inside0"), F.col("in")).otherwise(F.col("out")))
    rows = rows.withColumn("change", _opened("brackets")).withColumn("depth0", so_far("change"))
    rows = rows.withColumn("folded", _folded(F.col("brackets"), F.col("depth0")))
    # Between two containers there is no record, whichever was the last one.
    kind = F.when(F.col("folded.d") < 2, "o").otherwise(F.col("folded.kind"))
    rows = rows.withColumn("kind", kind).withColumn("kind0", F.last("kind", ignorenulls=True).over(before))
    starts = materialise(
        rows.select(
            FILE, SPLIT, "size", "bytes", "blank", "quotes", "change", "inside0", "depth0", "kind0",
            F.col("folded.d").alias("depth1"), F.col("folded.low").alias("low"),
        ),
        "splits",
    )
    # Text after the last brace is a piece without one; it must be blank. Every other piece has its brace in the file.
    total = starts.groupBy(FILE).agg(
        (F.sum("quotes") % 2).alias("quotes"), F.sum("change").alias("change"), F.max_by("blank", SPLIT).alias("blank"),
        (F.sum("bytes") - F.max("size")).alias("missing"),
    )
    fits = (F.col("quotes") == 0) & (F.col("change") == -F.col("missing")) & ((F.col("missing") == 0) | F.col("blank"))
    begun = starts.select(FILE, SPLIT, "inside0", "depth0", "kind0", "depth1", "low", (F.col("quotes") % 2 == 1).alias("odd"))
    return begun, total.select(FILE, fits.alias("fits"))


def _cut(runs: DataFrame, starts: DataFrame, files: DataFrame) -> DataFrame:
    """The runs of files that can be read, those within the array of records as ``cut``, an array of its records, of
    which the first may have begun before the run (``head``) and the last may go on (``tail``); others keep their text."""
    starts = starts.join(files.where("fits"), FILE, "left_semi")  # by file: without the text
    rows = runs.select(FILE, SPLIT, "text").join(starts, [FILE, SPLIT])
    head, tail = F.col("depth0") > 2, F.col("depth1") > 2
    within = (F.col("kind0") == "r") & (F.col("low") >= 2)
    within &= (head | ~F.col("inside0")) & (tail | (F.col("inside0") == F.col("odd")))
    # What is open where the run begins is opened before it, so that the rest of a record is matched as a whole one.
    lead = F.concat(F.repeat(F.lit("{"), F.col("depth0").cast("int") - 2), F.when(F.col("inside0"), '"}').otherwise(""))
    rows = rows.withColumn("lead", F.when(within, lead))
    rows = rows.withColumn("cut", F.regexp_extract_all(F.concat("lead", "text"), F.lit(_OBJECT), F.lit(1)))
    cut = F.when(~F.array_contains("cut", ""), F.col("cut"))
    rows = rows.withColumn("cut", cut).withColumn("text", F.when(F.col("cut").isNull(), F.col("text")))
    return materialise(rows.withColumns({"head": head, "tail": tail, "lead": F.length("lead")}), "cut")


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(parts), lambda p: p["text"]), "}")


def _scanned(rows: DataFrame, array: str) -> DataFrame:
    """``(file, split, record, text, ends, opens)`` of the runs that keep their text, scanned piece by piece: the text of
    every record or part of one, numbered within the run."""
    pieces = F.split(F.expr("left(text, length(text) - 1)"), "[}]")
    rows = rows.where("cut IS NULL").select(FILE, SPLIT, "inside0", "depth0", "kind0", F.posexplode(pieces).alias(AT, "value"))
    quotes, out, inn = _structure(F.col("value"), array)
    here = Window.partitionBy(FILE, SPLIT).orderBy(AT)
    before = here.rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    rows = rows.withColumns({"quotes": quotes, "out": out, "in": inn})
    rows = rows.withColumn("inside", (F.col("inside0").cast("int") + so_far("quotes")) % 2 == 1)
    rows = rows.withColumn("brackets", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")))
    rows = rows.withColumn("closed", F.col("inside") == (F.col("quotes") % 2 == 1))  # the brace stands outside strings
    rows = rows.withColumn("change", _opened("brackets") - F.col("closed").cast("int"))
    rows = rows.withColumn("depth", F.col("depth0") + so_far("change"))
    rows = rows.withColumn("opens", _folded(F.col("brackets"), F.col("depth"))["kind"])
    kind = F.coalesce(F.last("opens", ignorenulls=True).over(here), F.col("kind0"))
    rows = rows.withColumn("in_records", F.coalesce(kind == "r", F.lit(False)))
    back = F.col("closed") & (F.col("depth") + F.col("change") == 2)
    rows = rows.withColumn("ends", (back & F.col("in_records")).cast("int")).withColumn("record", so_far("ends"))
    return rows.where("in_records").groupBy(FILE, SPLIT, "record").agg(
        _joined(F.collect_list(F.struct(AT, F.col("value").alias("text")))).alias("text"),
        F.max("ends").alias("ends"),
        F.max(F.coalesce(F.col("opens") == "r", F.lit(False))).alias("opens"),
    )


def _over_borders(cut: DataFrame) -> DataFrame:
    """The records of ``cut`` that begin before their run or go on after it, as :func:`_scanned` has them."""
    parts = F.array(
        F.when(
            F.col("head"),
            F.struct(F.lit(0).alias("record"), F.expr("substr(cut[0], lead + 1)").alias("text"), (F.col("ends") > 0).alias("ends")),
        ),
        F.when(
            F.col("tail") & (F.col("ends") >= F.col("head").cast("int")),
            F.struct(F.col("ends").alias("record"), F.element_at("cut", -1).alias("text"), F.lit(False).alias("ends")),
        ),
    )
    part = F.explode(F.array_compact(parts)).alias("part")
    return cut.select(FILE, SPLIT, "record0", part).select(
        FILE, SPLIT, "record0", "part.record", F.expr("left(part.text, length(part.text) - 1)").alias("text"),
        F.col("part.ends").cast("int").alias("ends"), F.lit(False).alias("opens"),
    )


def split_records(spark: SparkSession, path: str | list[str], array: str = "dados", glob: str = "*.json") -> DataFrame:
    """``(file, record, json)``: every object of the array ``array`` of every document under ``path``, numbered from 0
    within its file. Writes the runs, as read and as cut, one row a run and the records of runs that are scanned to the
    shared folder."""
    runs = _staged(spark, path, array, glob)
    rows = _cut(runs, *_starts(runs))
    # Read for the records within runs and for those over borders; put together twice it would be half of all work.
    here = materialise(_scanned(rows, array), "records")
    cut = rows.where("cut IS NOT NULL").withColumn("ends", F.size("cut") - F.col("tail").cast("int"))

    ended = cut.select(FILE, SPLIT, "ends").unionByName(here.groupBy(FILE, SPLIT).agg(F.sum("ends").alias("ends")))
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    ended = materialise(ended.select(FILE, SPLIT, F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("record0")), "splits")
    cut, here = cut.join(ended, [FILE, SPLIT]), here.join(ended, [FILE, SPLIT])

    # The first record of a run may have begun before it, and one that does not end goes on in the next.
    first = F.col("head").cast("int")
    within = F.slice("cut", first + 1, F.greatest(F.col("ends") - first, F.lit(0)))
    whole = cut.select(FILE, (F.col("record0") + first).alias("first"), F.posexplode(within).alias("at", "json"))
    whole = whole.select(FILE, (F.col("first") + F.col("at")).alias("record"), "json")
    inner = (F.col("record") > 0) & (F.col("ends") == 1)
    parts = here.where(~inner).unionByName(_over_borders(cut)).groupBy(FILE, (F.col("record0") + F.col("record")).alias("record"))
    border = parts.agg(
        _joined(F.collect_list(F.struct(SPLIT, "text"))).alias("text"),
        F.max("ends").alias("ends"),
        F.max("opens").alias("opens"),
    ).where("ends = 1")
    here = here.where(inner).select(FILE, (F.col("record0") + F.col("record")).alias("record"), "text", "ends", "opens")
    opening = rf'(?s)^.*?"{re.escape(array)}"\s*:\s*\['
    text = F.when(F.col("opens"), F.regexp_replace("text", opening, "")).otherwise(F.col("text"))
    json = F.concat(F.regexp_replace(text, r"^[^{]*", ""), F.lit("}"))
    records = whole.unionByName(here.unionByName(border).select(FILE, "record", json.alias("json")))
    return records.select(F.col(FILE).alias("file"), F.col("record").cast("long").alias("record"), "json")


def read_split_envelopes(
    spark: SparkSession,
    path: str | list[str],
    record: T.StructType,
    glob: str = "*.json",
    whole: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The records of :func:`chronomart.sources.envelopes.read_envelopes`, a document being split between tasks.

    ``keep`` may name ``file`` and ``record``, the record's place.
    """
    rows = split_records(spark, path, glob=glob)
    if whole:
        return whole_records(rows.select(*keep, F.array(F.try_parse_json("json")).alias("dados")), record, *keep)
    return rows.select(*keep, F.from_json("json", record).alias("_r")).select(*keep, "_r.*")


def unreadable_files(spark: SparkSession, path: str | list[str], array: str = "dados", glob: str = "*.json") -> DataFrame:
    """``(file)`` of the documents that :func:`split_records` leaves out."""
    _, files = _starts(_staged(spark, path, array, glob))
    return files.where("not fits").select(F.col(FILE).alias("file"))
