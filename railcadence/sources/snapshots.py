"""Wide timetable snapshot files ({prefix}_YYYYMMDD_HHMMSS.csv)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from railcadence import schema as S
from railcadence.functions import text, times

# Field texts that stand for a missing value.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def snapshot_pattern(prefix: str) -> str:
    return rf"^{re.escape(prefix)}_\d{{8}}_\d{{6}}\.csv$"


def snapshot_name(path: Column) -> Column:
    """Snapshot of a file: the file itself, or the folder Spark wrote its parts to."""
    last, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(last.startswith("part-") & (folder != ""), folder).otherwise(last)


def snapshot_path(path: Column) -> Column:
    """Path of the whole snapshot a file belongs to."""
    return F.regexp_replace(path, r"/part-[^/]*$", "")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """file_name, path, modified of a landing folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        snapshot_name(F.col("path")).alias("file_name"),
        snapshot_path(F.col("path")).alias("path"),
        F.col("modificationTime").alias("modified"),
    )


def latest_snapshot(files: DataFrame, prefix: str, by: Sequence[str] = ()) -> DataFrame:
    """The newest file (by modification time) whose name fits the prefix, per ``by``.

    ``files`` needs file_name and modified; equal times are settled by name.
    """
    rest = [c for c in files.columns if c not in by]
    newest = F.max_by(F.struct(*rest), F.struct("modified", "file_name")).alias("_f")
    return (
        files.where(F.col("file_name").rlike(snapshot_pattern(prefix)))
        .groupBy(*by).agg(newest)
        .where(F.col("_f").isNotNull())
        .select(*by, "_f.*")
    )


# One CSV field. A quote counts at the start of a field only; text after the closing
# quote belongs to the field. Possessive throughout: one pass, no backtracking, no deep stack.
_FIELD = r'(?:"(?:[^"]++|"")*+"?+)?+[^,\n]*+'


_RECORD = rf"{_FIELD}(?:,{_FIELD})*+"
# A text that ends inside a quoted field.
_OPEN = r'\A(?:"(?:[^"]++|"")*+"[^,\n]*+[,\n]|[^",\n][^,\n]*+[,\n]|[,\n])*+"(?:[^"]++|"")*+\z'
# 128 lines of a file are looked at as one text. Texts are gathered in at most 128 groups at a time.
_SLICE_BITS = 7


def _clean_text(content: str) -> Column:
    return F.regexp_replace(content, "[\ufeff\r]", "")


def _is_header(line: Column, first_column: str) -> Column:
    return F.substring_index(line, ",", 1) == first_column


def read_records(
    spark: SparkSession, path: str | list[str], names: DataFrame | None = None, first_column: str = "mission"
) -> DataFrame:
    """file_name, header, keys, line of snapshot files, those listed in ``names`` (file_name) if given.

    The records are those of :func:`split_records`, but no file is held whole: it is read in slices
    of lines, and a record that reaches over slices is put together from its pieces.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    at = F.col("_metadata.file_path")
    lines = files.select(
        at.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),  # the lines of a block are read in order, by one task
        snapshot_name(at).alias("file_name"), "value",
    )
    # names and headers are one row per file, like the listing of files that the driver holds
    if names is not None:
        lines = lines.join(F.broadcast(names), "file_name", "left_semi")
    # one aggregate that both uses need whole, so that the lines are dealt out once for both
    gathered = F.array_sort(F.collect_list(F.struct("n", "value")))["value"]
    slices = lines.groupBy("path", "size", "block", F.shiftright("n", _SLICE_BITS).alias("slice")).agg(
        F.array_join(gathered, "\n").alias("raw")
    ).withColumns({"text": _clean_text("raw"), "bytes": F.octet_length("raw") + 1})
    located = slices.join(_slice_states(slices), ["path", "size", "block", "slice"])
    # a header record starts a line; other slices need not be split to find it
    starts = F.col("text").rlike(rf"(?:\A|\n){re.escape(first_column)}(?:[,\n]|\z)")
    headers = _records_of_slices(located, starts).where(_is_header(F.col("line"), first_column)).groupBy("path").agg(
        csv_fields(F.min("line")).alias("header")
    )
    keyed = headers.select("path", "header", text.normalize_keys(F.col("header")).alias("keys"))
    records = _records_of_slices(located).where(~_is_header(F.col("line"), first_column))
    return records.join(F.broadcast(keyed), "path").select(snapshot_name(F.col("path")).alias("file_name"), "header", "keys", "line")


def _slice_states(slices: DataFrame) -> DataFrame:
    """The slices without their text: before, after (1: inside a quoted field there), fresh, link, tail.

    A slice maps the state before it to the one after it: it keeps, turns or sets it. So one pass
    over two flags per slice gives all states. ``fresh`` tells that a record begins in the slice and goes
    on after it, ``link`` is the slice where the record begins that comes into this one. ``tail`` is the line
    break at the end of a file whose last field isn't closed; the reader of lines drops it.
    """
    text_, quote = F.col("text"), F.lit('"')
    inside, has_quote = F.concat(quote, text_), F.col("text").contains('"')
    notes = slices.select(
        "path", "size", "block", "slice", "bytes",
        (has_quote & text_.rlike(_OPEN)).cast("int").alias("_from_0"),
        (~has_quote | inside.rlike(_OPEN)).cast("int").alias("_from_1"),
        (has_quote & inside.rlike(rf"\A{_RECORD}\n")).alias("_ends"),
    )
    order = Window.partitionBy("path", "size").orderBy("block", "slice")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = notes.withColumn("_turns", F.sum(F.when(F.col("_from_0") > F.col("_from_1"), 1).otherwise(0)).over(so_far))
    fixed = F.when(F.col("_from_0") == F.col("_from_1"), (F.col("_from_0") + F.col("_turns")) % 2)
    after = ((F.coalesce(F.last(fixed, ignorenulls=True).over(so_far), F.lit(0)) + F.col("_turns")) % 2).cast("int")
    states = turns.withColumn("after", after).withColumns({
        "before": F.lag("after", 1, 0).over(order),
        "_last": F.lead("slice").over(order).isNull(),
        "_rest": F.col("size") - F.sum("bytes").over(Window.partitionBy("path", "size")),
    })
    fresh = (F.col("after") == 1) & ((F.col("before") == 0) | F.col("_ends"))
    # without a line break at its end a file is a byte shorter than its lines; a mark at its start has three
    unclosed = F.col("_last") & (F.col("after") == 1) & F.col("_rest").isin(0, 3)
    return states.withColumn("fresh", fresh).select(
        "path", "size", "block", "slice", "before", "after", "fresh",
        F.last(F.when(F.col("fresh"), F.struct("block", "slice")), ignorenulls=True).over(earlier).alias("link"),
        F.when(unclosed, "\n").otherwise("").alias("tail"),
    )


def _records_of_slices(located: DataFrame, wanted: Column | None = None) -> DataFrame:
    """path, line; with ``wanted`` of those slices only, and what reaches over slices."""
    opening = F.when(F.col("before") == 1, '"').otherwise("")
    # an open record reaches to the end of the text, where the pattern then fits once more, without any text
    found = F.regexp_extract_all(F.concat(opening, "text", "tail"), F.lit(rf"({_RECORD})(?:\n|\z)"), F.lit(1))
    n = F.size("found")
    inner = F.slice("found", F.col("before") + 1, F.greatest(F.lit(0), n - F.col("before") - 2 * F.col("after")))
    whole = (located if wanted is None else located.where(wanted)).withColumn("found", found)
    whole = whole.select("path", F.explode(inner).alias("line"))
    pieces = located.where("before + after > 0").withColumn("found", found).select("path", "block", "slice", F.explode(F.array_compact(F.array(
        F.when(F.col("before") == 1, F.struct("link", F.expr("substring(found[0], 2)").alias("piece"))),
        F.when(F.col("fresh"), F.struct(F.struct("block", "slice").alias("link"), F.get("found", n - 2).alias("piece"))),
    ))).alias("p"))
    joined = pieces.groupBy("path", "p.link").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "slice", "p.piece")))["piece"], "\n").alias("line")
    )
    return whole.unionByName(joined.select("path", "line")).where(F.length(F.trim("line")) > 0)


def split_records(files: DataFrame, content: str = "content", first_column: str = "mission") -> DataFrame:
    """Whole files to one row per record: file_name, header, keys, line.

    A quoted field may hold line breaks. The header is the record that starts with
    ``first_column``; files without one have no rows. Its names and their keys are
    worked out once per file. Blank records are left out.
    """
    records = F.regexp_extract_all(_clean_text(content), F.lit(rf"({_RECORD})(?:\n|\z)"), F.lit(1))
    listed = files.select("file_name", F.filter(records, lambda r: F.length(F.trim(r)) > 0).alias("lines"))

    def is_header(line: Column) -> Column:
        return _is_header(line, first_column)

    header = listed.select("*", csv_fields(F.array_min(F.filter("lines", is_header))).alias("header")).where(
        F.col("header").isNotNull()
    )
    keyed = header.select("*", text.normalize_keys(F.col("header")).alias("keys"))
    return keyed.select("file_name", "header", "keys", F.explode("lines").alias("line")).where(~is_header(F.col("line")))


def csv_fields(line: Column) -> Column:
    """Fields of one CSV record; quotes protect commas and line breaks, doubled quotes stand for one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_FIELD})"), F.lit(1))
    parts = r'(?s)^"((?:[^"]++|"")*+)"?+(.*)$'
    quoted = F.transform(raw, lambda f: F.when(f.startswith('"'), F.concat(
        F.replace(F.regexp_extract(f, parts, 1), F.lit('""'), F.lit('"')), F.regexp_extract(f, parts, 2),
    )).otherwise(f))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ",", -1))


def parsed_records(records: DataFrame, columns: Sequence[str] = S.SNAPSHOT_META) -> DataFrame:
    """Records to file_name, line, rejected, the listed ``columns`` as text, stops; see :func:`snapshot_rows`."""
    matched = records.withColumn("fields", csv_fields(F.col("line")))

    def field(i: Column) -> Column:
        value = F.get(F.col("fields"), i)
        return F.when(~value.isin(*NULL_WORDS), value)

    def named(name: str) -> Column:
        return field((F.array_position("header", name) - 1).cast("int")).alias(name)

    # one entry per header name that is not a listed column
    entries = F.transform("header", lambda h, i: F.struct(
        h.alias("column"), field(i).alias("value"), F.get("keys", i).alias("key")
    ))
    stops = F.filter(entries, lambda p: ~p["column"].isin(*columns))
    return matched.select(
        "file_name", "line", (F.size("fields") > F.size("header")).alias("rejected"), *[named(c) for c in columns], stops.alias("stops")
    )


def snapshot_rows(
    records: DataFrame, columns: Sequence[str] = S.SNAPSHOT_META
) -> tuple[DataFrame, DataFrame]:
    """Records to (rows, rejects).

    Files differ in their columns (only served stops are listed), so each record
    carries the header of its own file. Records with more fields than their header
    are rejected; missing fields at the end count as empty.

    rows     file_name, the listed ``columns`` as text, stops array<(column, value, key)>
    rejects  file_name, line
    """
    parsed = parsed_records(records, columns)
    rejects = parsed.where("rejected").select("file_name", "line")
    return parsed.where("not rejected").drop("line", "rejected"), rejects


def read_snapshot_csv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Snapshot files to (rows, rejects); see :func:`snapshot_rows`."""
    return snapshot_rows(read_records(spark, path))


def snapshot_passages(rows: DataFrame, kind: str, *more: str) -> DataFrame:
    """Snapshot rows to passages, one per stop with a readable time; ``more`` columns are kept.

    Trips without any time stay as one row without a stop.
    """
    timed = F.filter(
        F.transform("stops", lambda p, i: F.struct(
            times.parse_instant_utc(p["value"]).alias("t"),
            i.alias("stop_seq"),
            p["column"].alias("stop_name"),
            p["key"].alias("stop_key"),
        )),
        lambda c: c["t"].isNotNull(),
    )
    observed_at = times.parse_instant_utc("date_observation")
    calls = rows.withColumn("timed", timed).select("*", F.posexplode_outer("timed").alias("pos", "c"))
    return calls.select(
        "mission",
        F.coalesce("type_mission", text.mission_type(F.col("mission"))).alias("mission_type"),
        text.direction(F.col("mission")).alias("direction"),
        F.coalesce("destination", F.lit("")).alias("destination"),
        F.lit(kind).alias("kind"),
        F.lit(None).cast("int").alias("stop_id"),
        F.col("c.stop_key").alias("stop_key"),
        F.col("c.stop_seq").alias("stop_seq"),
        F.col("c.t").alias("t"),
        F.coalesce("pos", F.lit(0)).alias("call_pos"),
        F.coalesce("gare_depart", F.array_min("timed")["stop_name"]).alias("origin"),
        F.coalesce(F.col("nb_arrets_desservis").try_cast("double").cast("int"), F.size("timed")).alias("n_served"),
        F.array_max(F.col("timed.t")).alias("ends_at"),
        observed_at.alias("observed_at"),
        F.to_date(observed_at).alias("service_date"),
        *more,
    )


def snapshot_frame(passages: DataFrame, stops: Sequence[tuple[str, str]]) -> DataFrame:
    """Passages of one kind back to the wide snapshot layout.

    ``stops`` lists (stop_key, column name) in geographic order; all of them
    become columns, NULL where no train calls.
    """
    by = ["mission", "mission_type", "destination", "origin", "n_served", "observed_at"]
    wide = passages.groupBy(*by).agg(*[
        F.max(F.when(F.col("stop_key") == key, F.col("t"))).alias(f"t{i}") for i, (key, _) in enumerate(stops)
    ])
    return wide.select(
        "mission", F.col("mission_type").alias("type_mission"), "destination",
        *[F.col(f"t{i}").alias(name) for i, (_, name) in enumerate(stops)],
        F.col("origin").alias("gare_depart"),
        F.col("n_served").alias("nb_arrets_desservis"),
        F.col("observed_at").alias("date_observation"),
    )
