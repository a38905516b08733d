"""Column-level scalar rules (O-16, O-25, O-28, O-29, O-79 … O-85).

Every function takes and returns ``Column`` and uses only built-in
expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's for identical results.
ISBN13_PATTERN = "^(978|979)[0-9]{10}$"
INT_PREFIX = r"^\s*([+-]?[0-9]+)"
FLOAT_PREFIX = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
# White space as JavaScript's String.prototype.trim understands it.
_WS_CHARS = ("\t\n\u000b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
             "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Trim all leading/trailing white space (Spark ``trim`` strips only ' ');
    a character-set ``btrim``, no regular expression."""
    return F.btrim(col(c), F.lit(_WS_CHARS))


def blank_to_null(c) -> Column:
    """``x || null`` of the source: empty string becomes null."""
    return F.nullif(col(c), F.lit(""))


def valid_isbn13(c) -> Column:
    """O-25: 978/979 + 10 digits after trimming; no check digit."""
    return F.coalesce(trim_ws(c).rlike(ISBN13_PATTERN), F.lit(False))


def leading_int(c) -> Column:
    """O-16: ``parseInt(x, 10) || null`` — leading integer, 0/NaN to null."""
    v = F.regexp_extract(col(c), INT_PREFIX, 1)
    return F.nullif(v.try_cast("int"), F.lit(0))


def leading_float(c) -> Column:
    """``parseFloat(x)``: leading decimal number, else null (NaN)."""
    v = F.regexp_extract(col(c), FLOAT_PREFIX, 1)
    return v.try_cast("double")


def onix_date(c) -> Column:
    """O-20: ``YYYYMMDD…`` to a date; shorter than 8 chars or not a date to null."""
    s = col(c)
    return F.when(s.rlike("^[0-9]{8}"), F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd"))


def dmy_date(c) -> Column:
    """O-28: ``DD/MM/YYYY`` to a date; day ``00`` or an impossible date to null."""
    s = trim_ws(c)
    ok = s.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$") & (F.substring(s, 1, 2) != "00")
    iso = F.concat_ws("-", F.substring(s, 7, 4), F.substring(s, 4, 2), F.substring(s, 1, 2))
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


def dm2y_date(c) -> Column:
    """O-29: ``DD/MM/YY`` read as 20YY; impossible dates to null."""
    s = trim_ws(c)
    ok = s.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{2}$")
    iso = F.concat(F.lit("20"), F.substring(s, 7, 2), F.lit("-"), F.substring(s, 4, 2),
                   F.lit("-"), F.substring(s, 1, 2))
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


def slugify(c, max_len: int | None = 200) -> Column:
    """O-79: lower, runs of white space to ``_``, drop ``[^a-z0-9_-]``, cut."""
    s = F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"\s+", "_"), "[^a-z0-9_-]", "")
    return F.substring(s, 1, max_len) if max_len else s


def file_ext(c) -> Column:
    """Node ``path.extname`` of the base name: last dot not at position 0."""
    base = F.regexp_extract(col(c), "([^/]*)$", 1)
    return F.regexp_extract(base, r"^.+(\.[^.]*)$", 1)


def safe_filename(c, stamp) -> Column:
    """O-80: sanitised base name + ``_<stamp>`` + original extension."""
    base = F.regexp_extract(col(c), "([^/]*)$", 1)
    ext = file_ext(c)
    stem = F.substring(base, F.lit(1), F.length(base) - F.length(ext))
    return F.concat(slugify(stem, None), F.lit("_"), col(stamp).cast("string"), ext)


def feed_week(c) -> Column:
    """O-81: week number out of ``…_wk<n>_…``; ``unknown`` without one."""
    w = F.regexp_extract(col(c), "wk([0-9]+)_", 1)
    return F.when(w == "", F.lit("unknown")).otherwise(w)


def landing_key(filename, prefix: str, full: bool) -> Column:
    """O-81: object key a downloaded ONIX zip is landed under."""
    suffix = "full" if full else "delta"
    return F.concat(F.lit(f"{prefix}biblio-wk"), feed_week(filename), F.lit(f"-{suffix}.xml"))


def avail_source(filename) -> Column:
    """O-32: ``.000`` is the daily full snapshot, other sequences are deltas."""
    seq = F.regexp_extract(col(filename), r"\.([0-9]{3})$", 1)
    return F.when(seq == "000", F.lit("avail13_full")).otherwise(F.lit("avail13_delta"))


def cover_key(isbn) -> Column:
    """O-82: object key of a cover."""
    return F.concat(F.lit("covers/"), col(isbn), F.lit(".jpg"))


def public_url(base: str, key) -> Column:
    """O-82: public URL, one trailing ``/`` of the base stripped."""
    b = base[:-1] if base.endswith("/") else base
    return F.concat(F.lit(b + "/"), col(key))


def remote_cover_path(isbn) -> Column:
    """O-82: full-catalogue cover path, folder = first 8 digits of the ISBN."""
    return F.concat(F.lit("/Books/Full/"), F.substring(col(isbn), 1, 8), F.lit("/"),
                    col(isbn), F.lit(".jpg"))


def _set_param(params: Column, key: str, value: str) -> Column:
    """``URLSearchParams.set``: first occurrence takes the value, later ones go,
    appended at the end when absent."""
    keys = F.transform(params, lambda p: F.substring_index(p, "=", 1))
    first = F.array_position(keys, F.lit(key))
    kept = F.filter(
        F.transform(params, lambda p, i: F.when(F.substring_index(p, "=", 1) != key, p)
                    .when(i + 1 == first, F.lit(f"{key}={value}"))),
        lambda p: p.isNotNull())
    return F.when(first == 0, F.concat(kept, F.array(F.lit(f"{key}={value}")))).otherwise(kept)


def high_res_cover_url(url) -> Column:
    """O-83: https, ``zoom=5``, ``fife=w800``, no ``edge``; other params in place."""
    u = col(url)
    host = F.try_parse_url(u, F.lit("HOST"))
    path = F.coalesce(F.nullif(F.try_parse_url(u, F.lit("PATH")), F.lit("")), F.lit("/"))
    query = F.coalesce(F.try_parse_url(u, F.lit("QUERY")), F.lit(""))
    ref = F.try_parse_url(u, F.lit("REF"))
    params = F.filter(F.split(query, "&"), lambda p: p != "")
    params = _set_param(params, "zoom", "5")
    params = _set_param(params, "fife", "w800")
    params = F.filter(params, lambda p: F.substring_index(p, "=", 1) != "edge")
    out = F.concat(F.lit("https://"), F.lower(host), path, F.lit("?"), F.array_join(params, "&"),
                   F.when(ref.isNotNull(), F.concat(F.lit("#"), ref)).otherwise(F.lit("")))
    return F.when(host.isNotNull(), out)


def volume_id(url) -> Column:
    """O-83: ``id=`` parameter of a cover URL, null when absent."""
    return blank_to_null(F.regexp_extract(col(url), "[?&]id=([^&]+)", 1))


def image_ext(content_type) -> Column:
    """O-83: ``png`` when the content type says so, else ``jpg``."""
    ct = F.coalesce(col(content_type), F.lit("image/jpeg"))
    return F.when(ct.contains("png"), F.lit("png")).otherwise(F.lit("jpg"))


def uri_component(c) -> Column:
    """``encodeURIComponent``: Spark's form encoding, then the few differences undone."""
    s = F.url_encode(col(c))
    for enc, raw in (("\\+", "%20"), ("%7E", "~"), ("%21", "!"), ("%27", "'"),
                     ("%28", "("), ("%29", ")")):
        s = F.regexp_replace(s, enc, raw)
    return s


def lookup_query(isbn, title, first_author) -> Column:
    """O-84: ``isbn:x``, else ``intitle:t`` (+ ``+inauthor:a``), URI-encoded."""
    q = F.when(
        F.coalesce(col(isbn), F.lit("")) != "", F.concat(F.lit("isbn:"), col(isbn))
    ).otherwise(
        F.concat(F.lit("intitle:"), F.coalesce(col(title), F.lit("")),
                 F.when(F.coalesce(col(first_author), F.lit("")) != "",
                        F.concat(F.lit("+inauthor:"), col(first_author))).otherwise(F.lit("")))
    )
    return uri_component(q)


def parse_vector(c) -> Column:
    """O-85: text ``[a,b,…]`` to ``array<float>``."""
    return F.from_json(col(c), "array<float>")


def format_vector(c) -> Column:
    """O-85: ``array<float>`` to text ``[a,b,…]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(col(c), lambda x: x.cast("string")), ","),
                    F.lit("]"))
