"""O-01 / O-02: splittable ONIX XML scan.

An ONIX file is a flat sequence of ``<Product>`` elements. Reading it as text
with ``</Product>`` as the record separator gives one record per product and
lets Spark split a multi-GB file across many tasks; each record is then cut
from its ``<Product`` open tag and parsed with ``from_xml`` against a declared
schema. (``format("xml")`` would read a single file in one task.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.session import BROADCAST_ROW_LIMIT


# XHTML elements inside texts that separate words.
_BLOCKS = "p|br|div|li|ul|ol|dl|dt|dd|h[1-6]|hr|table|tr|td|th|blockquote|pre"
# Tags of XHTML: lower-case names without a prefix (ONIX names begin with a capital).
_BLOCK_TAG = rf"</?(?:{_BLOCKS})(?:\s[^<>]*)?/?>"
_INLINE_TAG = r"</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>"
_XHTML = r"</?[a-z]"
# Not inside a CDATA section: its end does not come before the next section's start.
_OUTSIDE = r"(?!(?:(?!<!\[CDATA\[)[\s\S])*?\]\]>)"


def plain_text_markup(fragment: Column) -> Column:
    """A product's source without XHTML tags: block tags become spaces, inline
    tags nothing. Entities are not decoded yet, so an escaped ``<`` is no tag, and
    CDATA sections keep what they hold."""
    def without(outside: str) -> Column:
        return F.regexp_replace(F.regexp_replace(fragment, _BLOCK_TAG + outside, " "), _INLINE_TAG + outside, "")
    # Most records have no such tag, which one look shows.
    return (F.when(~F.regexp_like(fragment, F.lit(_XHTML)), fragment)
            .when(F.contains(fragment, F.lit("<![CDATA[")), without(_OUTSIDE)).otherwise(without("")))


class CorruptOnixError(ValueError):
    """Raised by ``scan_onix(fail_fast=True)`` when any fragment or file is broken."""


def _arrival(mtime, path, block, seq):
    return F.struct(mtime.alias("mtime"), path.alias("file"), block.alias("block"), seq.alias("pos"))


def file_columns(df: DataFrame) -> DataFrame:
    """A text scan (batch or stream) with its file metadata as plain columns."""
    return df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.col("_metadata.file_block_start").alias("file_block"),
    )


def with_arrival(df: DataFrame) -> DataFrame:
    """File order of each record: (mtime, file, split start, position in split).
    Batch-only (a stream gets it inside ``foreachBatch``)."""
    return df.withColumn("arrival", _arrival(F.col("file_mtime"), F.col("source_file"), F.col("file_block"),
                                             F.monotonically_increasing_id()))


def onix_records(df: DataFrame, tag: str = "Product") -> DataFrame:
    """Raw ``</Product>``-separated records of a batch text scan with their
    file-order ``arrival``."""
    return with_arrival(file_columns(df)).select("value", "source_file", "arrival")


def read_onix_text(spark: SparkSession, paths, tag: str = "Product") -> DataFrame:
    return spark.read.option("lineSep", f"</{tag}>").option("recursiveFileLookup", "true").text(paths)


def scan_onix(spark: SparkSession, paths, fail_fast: bool = False, tag: str = "Product",
              end_tag: str = "ONIXMessage", check_tail: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scan ONIX files into raw product structs.

    Returns ``(records, corrupt)``:

    * ``records``: ``product`` (struct per ``schemas.ONIX_PRODUCT``), ``arrival``
      (struct mtime, file, block, pos: file order, comparable across files),
      ``source_file``;
    * ``corrupt``: ``source_file``, ``arrival``, ``fragment`` (raw text),
      ``reason`` — broken fragments, files cut short (no closing root tag), and
      products under another name-space prefix than ``tag`` (read those with it).

    ``check_tail`` makes a file all-or-nothing: its records count only when the
    file ends in the closing root tag. It costs a second (pruned, aggregated)
    pass over the text; turn it off for files already known to be whole.
    """
    text = read_onix_text(spark, paths, tag)
    n_files = len(text.inputFiles())
    records, corrupt = parse_onix(onix_records(text, tag), tag, end_tag, check_tail, n_files)
    if fail_fast:
        bad = corrupt.limit(1).collect()
        if bad:
            raise CorruptOnixError(f"malformed ONIX in {bad[0]['source_file']}: {bad[0]['reason']}")
    return records, corrupt


def scan_onix_once(spark: SparkSession, paths, tag: str = "Product") -> DataFrame:
    """The rows of both frames of ``scan_onix`` in one (see ``parse_onix_once``)."""
    text = read_onix_text(spark, paths, tag)
    return parse_onix_once(onix_records(text, tag), tag, n_files=len(text.inputFiles()))


def _cut(raw: DataFrame, tag: str, end_tag: str) -> DataFrame:
    """(source_file, arrival, fragment, is_tail, other) of every raw record."""
    # cut from the product's open tag: find its position, then take the rest
    # (no capture of the whole record by the regex engine)
    start = F.regexp_instr("value", F.lit(rf"<{tag}[\s>/]"))
    frag = F.when(start > 0, F.substr(F.col("value"), start)).otherwise(F.lit(""))
    return raw.select("source_file", "arrival", frag.alias("fragment"),
                      F.col("value").contains(f"</{end_tag}>").alias("is_tail"),
                      F.regexp_like("value", F.lit(rf"<(?!{tag}[\s>/])([A-Za-z_][\w.-]*:)?{tag.split(':')[-1]}[\s>/]")).alias("other"))


def _with_complete(products: DataFrame, staged: DataFrame, n_files: int | None) -> DataFrame:
    """A file is whole only if some record holds the closing root tag. The
    per-file table has one row per input file; the file listing (driver
    metadata, no data read) bounds it, so it is broadcast and the fragments
    never shuffle."""
    files = staged.groupBy("source_file").agg(F.bool_or("is_tail").alias("complete"))
    if n_files is not None and n_files <= BROADCAST_ROW_LIMIT:
        files = F.broadcast(files)
    return products.join(files, "source_file")


def _xml(tag: str) -> Column:
    return F.from_xml(F.concat(plain_text_markup(F.col("fragment")), F.lit(f"</{tag}>")), schemas.ONIX_PRODUCT,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT,
                       "ignoreNamespace": "true"})


def _bad_fragment() -> Column:
    return F.col(f"product.{schemas.CORRUPT}").isNotNull() | F.col("product").isNull()


def parse_onix_once(raw: DataFrame, tag: str = "Product", end_tag: str = "ONIXMessage", n_files: int | None = None) -> DataFrame:
    """The rows of both frames of ``parse_onix`` in one, for jobs that need both: each
    fragment is parsed once. ``product, arrival, source_file, fragment, reason``;
    ``reason`` is null for a good record, ``fragment`` for all but broken and cut ones."""
    staged = _cut(raw, tag, end_tag)
    rows = _with_complete(staged.where((F.col("fragment") != "") | F.col("other")), staged, n_files)
    parsed = rows.select("source_file", "arrival", "fragment", "complete", F.inline(F.array(F.struct(
        F.when(F.col("fragment") != "", _xml(tag)).alias("product")))))
    reason = (F.when(F.col("fragment") == "", F.lit("other_prefix")).when(_bad_fragment(), F.lit("malformed"))
              .when(~F.col("complete"), F.lit("file_truncated")))
    return parsed.select("product", "arrival", "source_file", F.when(reason != "other_prefix", F.col("fragment")).alias("fragment"),
                         reason.alias("reason"))


def parse_onix(raw: DataFrame, tag: str = "Product", end_tag: str = "ONIXMessage", check_tail: bool = True,
               n_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Fragments -> product structs (see ``scan_onix``); ``raw`` from ``onix_records``.

    ``n_files`` bounds the per-file completeness table (broadcast when small)."""
    staged = _cut(raw, tag, end_tag)

    # Products under another prefix than ``tag`` has would be passed over: they are reported.
    foreign = staged.where(F.col("other") & (F.col("fragment") == "")).select(
        "source_file", "arrival", F.lit(None).cast("string").alias("fragment"), F.lit("other_prefix").alias("reason"))
    products = staged.where(F.col("fragment") != "").drop("other")
    if check_tail:
        products = _with_complete(products, staged, n_files)
    else:
        products = products.withColumn("complete", F.lit(True))
    # the parser runs inside a generator so that it is evaluated once per
    # fragment: a plain projection would be inlined into every field access
    parsed = products.select("source_file", "arrival", "fragment", "complete",
                             F.inline(F.array(F.struct(_xml(tag).alias("product")))))

    bad_fragment = _bad_fragment()
    records = (parsed.where(~bad_fragment & F.col("complete"))
               .select("product", "arrival", "source_file"))
    corrupt = parsed.where(bad_fragment | ~F.col("complete")).select(
        "source_file", "arrival", "fragment",
        F.when(bad_fragment, F.lit("malformed")).otherwise(F.lit("file_truncated")).alias("reason"),
    ).unionByName(foreign)
    return records, corrupt
