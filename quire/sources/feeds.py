"""Feed files: manifest, feed rules, DONE gate, delimited scans (O-03 … O-08, O-27, O-38).

Delimited feeds are read as text lines (splittable, one record per line) and
each line is split with ``from_csv``: a short row fills missing cells with
``''``, extra cells are ignored, quotes inside a field come through as text,
doubled quotes in a quoted field stand for one, and a line with a quoted field
that is not closed is counted as a parse error instead of failing the file.
A quoted field may hold line breaks (``joined_lines``). JSON documents are cut at element borders.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage, stage_path

# File naming rules of the wholesaler feeds (case-insensitive).
# {prefix}: the vendor's name that the weekly ONIX zips begin with.
FEED_RULES = [
    # feed, filename pattern, needs a .DONE sibling
    ("inventory", r"^IV[0-9]{8}\.TXT$", True),
    ("avail13", r"^AV_[0-9]{8}\.[0-9]{3}$", False),
    ("biblio_delta", r"^{prefix}ONIX3_wk([0-9]+)_Delta\.zip$", False),
    ("biblio_full", r"^{prefix}ONIX3_wk([0-9]+)_Full\.zip$", False),
    ("covers_update", r"^BookImages_wk[0-9]+\.zip$", False),
    ("promotions", r"^GARDPROM13\.CSV$", False),
    ("firm_sale", r"^FIRMSALE13\.CSV$", False),
    ("isbn_slips", r"^ISBNSL13\.CSV$", False),
    ("market_restrictions", r"^RESTRICT\.CSV$", False),
    ("regions", r"^REGIONS\.CSV$", False),
]

MAX_COVER_ZIP_BYTES = 5 * 1024 * 1024 * 1024


def list_files(spark: SparkSession, paths, suffix: str | None = None) -> DataFrame:
    """O-03: manifest ``path, filename, modified_at, size`` of the files under ``paths``.

    ``binaryFile`` with only metadata columns selected never reads file bodies.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
          .select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("filename"),
                  F.col("modificationTime").alias("modified_at"), F.col("length").alias("size")))
    if suffix:
        df = df.where(F.col("filename").endswith(suffix))
    return df


def feed_rules(spark: SparkSession, onix_prefix: str, rules=FEED_RULES) -> DataFrame:
    """The rule table; ``onix_prefix`` is the vendor's prefix of the weekly ONIX zips."""
    named = [(f, "(?i)" + p.replace("{prefix}", re.escape(onix_prefix)), d) for f, p, d in rules]
    return spark.createDataFrame(named,
                                 "feed string, pattern string, needs_done boolean")


def match_feed(manifest: DataFrame, rules: DataFrame, feed: str | None = None) -> DataFrame:
    """O-04: tag each file with the feed whose filename rule it matches.

    The rule table is a fixed handful of rows, so it is broadcast and the
    manifest never shuffles (a broadcast nested-loop join on ``rlike``).
    """
    r = rules
    if feed:
        r = r.where(F.col("feed") == feed)
    return manifest.join(F.broadcast(r), F.expr("filename rlike pattern")).drop("pattern")


def done_gate(manifest: DataFrame, only_needing: bool = False, listing: DataFrame | None = None) -> DataFrame:
    """O-05: keep a file only when ``<path>.DONE`` is also listed.

    ``listing``: the full directory listing the sentinels are looked up in
    (default: ``manifest`` itself). With ``only_needing`` (manifest tagged by
    ``match_feed``) the gate applies to feeds that need it and lets others through.
    """
    src_list = listing if listing is not None else manifest
    done = src_list.select(F.col("path").alias("__done")).where(F.col("__done").endswith(".DONE"))
    gated = manifest.join(done, F.concat(F.col("path"), F.lit(".DONE")) == F.col("__done"), "left_semi")
    if not only_needing:
        return gated
    return gated.where(F.col("needs_done")).unionByName(manifest.where(~F.col("needs_done")))


def split_oversize(manifest: DataFrame, limit: int = MAX_COVER_ZIP_BYTES) -> tuple[DataFrame, DataFrame]:
    """O-38: ``(ok, too_big)`` by file size."""
    big = F.col("size") > F.lit(limit)
    return manifest.where(~big), manifest.where(big)


def oversize(limit: int = MAX_COVER_ZIP_BYTES, feed: str = "covers_update") -> Column:
    """O-38 as a flag column (one pass over a tagged manifest): a file of
    ``feed`` larger than ``limit`` is recorded as failed, not read."""
    return F.coalesce((F.col("feed") == feed) & (F.col("size") > F.lit(limit)), F.lit(False))


def scan_lines(spark: SparkSession, paths) -> DataFrame:
    """Non-empty text lines with file-order ``arrival`` (mtime, file, block, pos)."""
    return text_lines(spark.read.option("recursiveFileLookup", "true").text(paths))


def text_lines(text: DataFrame) -> DataFrame:
    """``scan_lines`` on an existing batch text scan."""
    return lines_with_arrival(raw_lines(text))


def raw_lines(text: DataFrame) -> DataFrame:
    """Non-empty lines of a text scan (batch or stream) with file metadata columns."""
    return (text.select(F.col("value").alias("line"),
                        F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.file_name").alias("file_name"),
                        F.col("_metadata.file_modification_time").alias("file_mtime"),
                        F.col("_metadata.file_block_start").alias("file_block"))
            .where(F.trim(F.col("line")) != ""))


def lines_with_arrival(lines: DataFrame) -> DataFrame:
    """File order of each line (batch only; a stream adds it per micro-batch)."""
    return lines.withColumn("arrival", F.struct(
        F.col("file_mtime").alias("mtime"), F.col("source_file").alias("file"),
        F.col("file_block").alias("block"), F.monotonically_increasing_id().alias("pos"))).drop("file_block")


_CSV_OPTS = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "escape": '"'}

# A line of closed fields: quoted ones (a doubled quote stands for one), or plain ones, which may hold quotes.
_FIELD = r'(?:\s*+"(?:[^"]|"")*+"[^,]*+|(?!\s*+")[^,]*+)'
_CLOSED = rf"(?s)^{_FIELD}(?:,{_FIELD})*+$"


def _with_cells(df: DataFrame, line: str, n: int, out: str = "__cells") -> DataFrame:
    """Parse ``line`` once per row and expose the cells as an array column ``out``.

    The parser runs inside a generator (``inline`` of a one-element array), a
    plan node the optimizer does not merge into later projections; otherwise it
    inlines the parser into every cell access and parses each line once per cell."""
    ddl = ", ".join(f"__c{i} STRING" for i in range(n))
    parsed = df.select("*", F.inline(F.array(F.from_csv(F.col(line), ddl, _CSV_OPTS))))
    cells = [f"__c{i}" for i in range(n)]
    return parsed.withColumn(out, F.array(*[F.col(c) for c in cells])).drop(*cells)


def _parse_error(line: Column) -> Column:
    """A field that opens with a quote and never closes it makes the row unparseable."""
    return F.contains(line, F.lit('"')) & ~line.rlike(_CLOSED)


# The same, with nothing but blanks behind a closing quote.
_STRICT_FIELD = r'(?:\s*+"(?:[^"]|"")*+"\s*+|(?!\s*+")[^,]*+)'
_STRICT = rf"(?s)^{_STRICT_FIELD}(?:,{_STRICT_FIELD})*+$"
RECORD_LINES = 64       # a quote that is not closed within so many lines opens no record


def joined_lines(lines: DataFrame) -> DataFrame:
    """O-08: lines of a quoted field that holds line breaks become one line.

    A line turns "inside a quoted field" or "outside" into what holds behind it: lines
    without quotes change nothing, most others lead to one state from either, a few swap
    them. The state before a line is therefore the last fixed one with the swaps since,
    a prefix scan in two levels: over the few splits of a file, and inside a split;
    so a large file is no single task. Frames without an open quote pass unchanged. A
    quote that is still open at the end of its file or after RECORD_LINES lines, or whose
    record is no sound one (text behind a closing quote), is a parse error of its own line only."""
    opened = _parse_error(F.col("line"))
    if not lines.where(opened).limit(1).count():
        return lines
    whole = F.struct(F.col("arrival.block").alias("b"), F.col("arrival.pos").alias("p"))
    after_open = ~F.concat(F.lit('"'), F.col("line")).rlike(_CLOSED)
    x = lines.withColumns({"__a": opened.cast("int"), "__z": after_open.cast("int"), "__o": whole, "__b": F.col("arrival.block")})
    fixed = F.when(F.col("__a") == F.col("__z"), F.col("__a"))
    swap = ((F.col("__a") == 1) & (F.col("__z") == 0)).cast("int")
    x = x.withColumns({"__f": fixed, "__s": swap})
    inner = Window.partitionBy("source_file", "__b").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    # Inside a split: the last fixed state before the line, and the swaps up to it and in all.
    x = x.withColumns({"__swaps": F.coalesce(F.sum("__s").over(inner), F.lit(0))})
    x = x.withColumn("__mark", F.when(F.col("__f").isNotNull(), F.struct(F.col("__f").alias("f"), (F.col("__swaps") + F.col("__s")).alias("s"))))
    x = x.withColumn("__last", F.last("__mark", ignorenulls=True).over(inner))
    splits = x.groupBy("source_file", "__b").agg(
        F.max_by("__mark", F.when(F.col("__mark").isNotNull(), F.col("__o"))).alias("m"), F.sum("__s").alias("n"))
    outer = Window.partitionBy("source_file").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("n").over(outer), F.lit(0))
    splits = splits.withColumn("t", total).withColumn("v", F.when(F.col("m").isNotNull(), F.struct(
        F.col("m.f").alias("f"), (F.col("t") + F.col("m.s")).alias("s"))))
    before = F.last("v", ignorenulls=True).over(outer)
    splits = splits.withColumn("e", F.coalesce((before["f"] + F.col("t") - before["s"]) % 2, F.col("t") % 2)).select(
        "source_file", "__b", F.col("e").alias("__enter"))
    x = x.join(splits, ["source_file", "__b"])
    state = F.coalesce((F.col("__last.f") + F.col("__swaps") - F.col("__last.s")) % 2, (F.col("__enter") + F.col("__swaps")) % 2)
    x = x.withColumn("__in", state == 1).withColumn("__out", F.when(F.col("__in"), F.col("__z")).otherwise(F.col("__a")) == 1)
    kept = [c for c in lines.columns]
    alone = x.where(~F.col("__in") & ~F.col("__out")).select(*kept)

    # Lines of records over several lines: each hangs on the last line that began one.
    parts, path = x.where(F.col("__in") | F.col("__out")).select(*kept, "__o", "__b", "__in", "__out"), stage_path(lines.sparkSession, "broken-lines")
    parts.write.parquet(path)       # few rows, read several times
    parts = lines.sparkSession.read.schema(parts.schema).parquet(path)
    begun = F.when(~F.col("__in"), F.col("__o"))
    ends = parts.groupBy("source_file", "__b").agg(F.max(begun).alias("s"))
    ends = ends.select("source_file", "__b", F.last("s", ignorenulls=True).over(outer).alias("__before"))
    here = Window.partitionBy("source_file", "__b").orderBy("__o").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.join(ends, ["source_file", "__b"]).withColumn(
        "__start", F.coalesce(F.last(begun, ignorenulls=True).over(here), F.col("__before")))
    at = ["source_file", "__start"]
    sizes = parts.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.max_by("__out", "__o").alias("open"))
    few = parts.join(sizes.where((F.col("n") <= RECORD_LINES) & ~F.col("open")).select(*at), at, "left_semi")
    rest = [c for c in kept if c not in ("line", "source_file")]
    one = few.groupBy(*at).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__o", "line"))), lambda v: v["line"]), "\n").alias("line"),
        *(F.min_by(c, "__o").alias(c) for c in rest)).where(F.col("line").rlike(_STRICT))
    return alone.unionByName(one.select(*kept)).unionByName(parts.join(one.select(*at), at, "left_anti").select(*kept))


def _trailer(cells: Column) -> tuple[Column, Column]:
    is_t = F.coalesce(F.trim(cells[0]) == "TRAILER", F.lit(False))
    return is_t, F.when(is_t, F.trim(cells[1]).try_cast("long"))


def scan_positional(spark: SparkSession, paths, columns: Sequence[str]) -> DataFrame:
    """O-07 / O-08: unframed feed, cells named by position; missing cells are ``''``.

    Output: the named columns, ``is_trailer``, ``trailer_count``, ``parse_error``,
    ``source_file``, ``file_name``, ``file_mtime``, ``arrival``.
    """
    return positional(scan_lines(spark, paths), columns)


def positional(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``scan_positional`` on lines from ``scan_lines``/``text_lines``."""
    lines = joined_lines(lines)
    is_t, t_count = _trailer(F.col("__cells"))
    return (_with_cells(lines, "line", max(len(columns), 2))
            .select(*[F.coalesce(F.col("__cells")[i], F.lit("")).alias(c) for i, c in enumerate(columns)],
                    is_t.alias("is_trailer"), t_count.alias("trailer_count"),
                    _parse_error(F.col("line")).alias("parse_error"),
                    "source_file", "file_name", "file_mtime", "arrival"))


def scan_framed(spark: SparkSession, paths, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Framed feed files at ``paths`` (see ``framed``)."""
    return framed(scan_lines(spark, paths), aliases)


def framed(lines_in: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """O-06 / O-27: framed feed — first line dropped whatever it says, the next
    line names the columns, ``TRAILER,n`` rows carry the row count.

    ``aliases``: output column -> header names to try in order (first present
    wins). Header names are resolved per file inside Spark: the two first lines
    of each file are found by a per-file ``min`` over the file's first split,
    and the per-file result (one row per file) is joined back. Lines are split
    into as many cells as the widest header has (one number, found first).
    """
    place = F.struct(F.col("arrival.block"), F.col("arrival.pos"))
    lines = joined_lines(lines_in).withColumn("__o", place)
    head = lines_in.withColumn("__o", place).where(F.col("arrival.block") == 0)      # the two first lines are never broken
    first = head.groupBy("source_file").agg(F.min("__o").alias("__o1"))
    after = head.join(first, "source_file").where(F.col("__o") > F.col("__o1"))
    second = after.groupBy("source_file").agg(F.min_by("line", "__o").alias("__header"),
                                              F.min("__o").alias("__o2"))
    second = cut_lineage(second)     # one row per file, read for the width and for the join
    width = max(2, second.agg(F.max(F.size(F.split("__header", ",")))).first()[0] or 0)
    idx = {}
    for out, names in aliases.items():
        pos = [F.nullif(F.array_position(F.col("__hdr"), n), F.lit(0)) for n in names]
        idx[out] = F.coalesce(*pos) if len(pos) > 1 else pos[0]
    files = (_with_cells(second, "__header", width, "__hdr")
             .select("source_file", "__o2", *[v.alias(f"__i_{k}") for k, v in idx.items()]))
    body = lines.join(files, "source_file").where(F.col("__o") > F.col("__o2"))
    body = _with_cells(body, "line", width)
    is_t, t_count = _trailer(F.col("__cells"))
    vals = [F.when(F.col(f"__i_{k}").isNotNull(),
                   F.coalesce(F.element_at(F.col("__cells"), F.col(f"__i_{k}").cast("int")), F.lit("")))
            .alias(k) for k in aliases]
    return body.select(*vals, is_t.alias("is_trailer"), t_count.alias("trailer_count"),
                       _parse_error(F.col("line")).alias("parse_error"),
                       "source_file", "file_name", "file_mtime", "arrival")


_STRING = r'"(?:[^"\\]|\\.)*+"'
_HEAD = rf'(?:[^"{{]|{_STRING})*+'          # up to the next brace outside strings


def json_elements(spark: SparkSession, paths, field: str) -> DataFrame:
    """The objects of the array ``field`` at the root of JSON documents (one a file), each as text:
    ``source_file, file_mtime, pos, value``; ``pos`` counts a file's objects from 0.

    Files are read as text that ends at closing braces, so that a large document gives many
    tasks. Whether a piece begins inside a string and how many braces are open there follows
    from the quotes and braces before it: prefix sums in two levels, over the splits of a file (taken
    for either state at a split's start) and inside a split. Objects of one piece, which most are, are never
    gathered; the others are put together from their pieces. Elements that are no objects are passed
    over. A document whose strings and braces are not closed gives no rows."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(paths)
    x = text.select(F.col("value").alias("f"), F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_modification_time").alias("file_mtime"),
                    F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("p"))
    clean = F.regexp_replace("f", r"(?s)\\.", "")
    x = x.withColumns({"odd": F.length(F.regexp_replace(clean, '[^"]', "")) % 2})
    inner = Window.partitionBy("source_file", "b").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("source_file").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("flips", F.coalesce(F.sum("odd").over(inner), F.lit(0)) % 2)

    def braces(inside: Column) -> Column:
        """Braces opened less those closed in a piece and the brace behind it, for the state at its start."""
        shown = F.when(inside == 1, F.concat(F.lit('"'), clean)).otherwise(clean)
        shown = F.regexp_replace(shown, '"[^"]*+("|$)', "")
        return F.length(F.regexp_replace(shown, "[^{]", "")) - F.when((inside + F.col("odd")) % 2 == 0, F.lit(1)).otherwise(F.lit(0))
    for k in (0, 1):
        x = x.withColumn(f"d{k}", braces((F.col("flips") + k) % 2))
    # Per split: the state and the depth at its start.
    at = x.groupBy("source_file", "b").agg(F.sum("odd").alias("odd"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"),
                                           F.max_by("f", "p").alias("tail"))
    at = at.withColumn("s", F.coalesce(F.sum("odd").over(outer), F.lit(0)) % 2)
    at = at.withColumn("d", F.when(F.col("s") == 1, F.col("d1")).otherwise(F.col("d0")))
    at = at.withColumn("open", F.coalesce(F.sum("d").over(outer), F.lit(0)))
    at = cut_lineage(at.select("source_file", "b", "s", "d", "open", "odd", "tail"))
    # The text behind the last brace is a piece too, though no brace follows it.
    end = at.groupBy("source_file").agg(F.sum("d").alias("d"), F.sum("odd").alias("odd"), F.max_by("tail", "b").alias("tail"))
    blank = F.trim(F.regexp_replace("tail", r"[\s\x{FEFF}]+", "")) == ""
    sound = end.where((F.col("odd") % 2 == 0) & (F.col("d") + F.when(blank & (F.col("d") < 0), F.lit(1)).otherwise(F.lit(0)) == 0))
    at = at.join(sound.select("source_file"), "source_file", "left_semi").select("source_file", "b", "s", "open")

    x = x.join(at, ["source_file", "b"])
    x = x.withColumns({"inside": (F.col("flips") + F.col("s")) % 2,
                       "delta": F.when(F.col("s") == 1, F.col("d1")).otherwise(F.col("d0"))})
    x = x.withColumn("depth", F.col("open") + F.coalesce(F.sum("delta").over(inner), F.lit(0)))
    first = F.regexp_extract("f", rf"(?s)^([\s\x{{FEFF}}]*+\{{{_HEAD})\{{", 1)         # behind the root's own brace
    later = F.regexp_extract("f", rf"(?s)^({_HEAD})\{{", 1)
    head = F.when(F.col("inside") == 0, F.when(F.col("depth") == 0, first).when(F.col("depth") == 1, later))
    x = x.withColumn("head", F.when(head != "", head).when(
        (F.col("inside") == 0) & (F.col("depth") == 1) & F.startswith("f", F.lit("{")), F.lit("")))
    bare = F.regexp_replace("head", rf"(?s):\s*{_STRING}", ":0")
    name = F.element_at(F.regexp_extract_all(bare, F.lit(rf"(?s)({_STRING})\s*:"), 1), -1)
    is_list = bare.rlike(r"(?s):\s*\[[^\[\]:]*$")
    x = x.withColumns({"starts": F.col("head").isNotNull().cast("int"),
                       "field": F.when(F.contains(bare, F.lit(":")), F.when(is_list, name).otherwise(F.lit("")))})
    upto = Window.partitionBy("source_file", "b").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"named": F.last("field", ignorenulls=True).over(upto)})
    wanted = F.lit(f'"{field}"')
    # Per split: the field that is open at its start.
    names = x.groupBy("source_file", "b").agg(F.max_by("field", F.when(F.col("field").isNotNull(), F.col("p"))).alias("field"))
    names = names.select("source_file", "b", F.last("field", ignorenulls=True).over(outer).alias("before"))
    x = x.join(names, ["source_file", "b"]).withColumn("mine", F.coalesce("named", "before") == wanted)
    x = x.where("mine").withColumn("nth", F.sum("starts").over(upto))
    counts = x.groupBy("source_file", "b").agg(F.sum("starts").alias("n"))
    counts = cut_lineage(counts.select("source_file", "b", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("earlier")))
    x = x.join(counts, ["source_file", "b"]).withColumn("pos", F.col("earlier") + F.col("nth") - 1)
    ends = F.col("depth") + F.col("delta") == 1
    piece = F.when(F.col("starts") == 1, F.substring("f", F.length("head") + 1, F.length("f"))).otherwise(F.col("f"))
    x = x.select("source_file", "file_mtime", "pos", "b", "p", "depth", "starts", piece.alias("piece"), ends.alias("ends"))
    whole = x.where((F.col("starts") == 1) & F.col("ends")).select("source_file", "file_mtime", "pos", F.concat("piece", F.lit("}")).alias("value"))
    parts = x.where(((F.col("starts") == 1) & ~F.col("ends")) | ((F.col("starts") == 0) & (F.col("depth") >= 2)))
    joined = parts.groupBy("source_file", "file_mtime", "pos").agg(F.sort_array(F.collect_list(F.struct("b", "p", "piece"))).alias("t"))
    return whole.unionByName(joined.select("source_file", "file_mtime", "pos", F.concat(F.array_join("t.piece", "}"), F.lit("}")).alias("value")))


def read_excerpts(spark: SparkSession, paths) -> DataFrame:
    """O-09: excerpt feed documents (one JSON document per file) -> one row per excerpt.

    A missing ``excerpts`` array reads as empty. A large document is read by many tasks."""
    from quire.schemas import EXCERPT_FEED

    kind = EXCERPT_FEED["excerpts"].dataType.elementType
    return (json_elements(spark, paths, "excerpts")
            .select("source_file", "file_mtime", F.col("pos").cast("int").alias("pos"), F.inline(F.array(F.from_json("value", kind)))))
