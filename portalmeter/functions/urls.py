"""Cleaning of page paths and file addresses."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_host(url: Column) -> Column:
    """Drop a scheme and host, or a first path segment that looks like a host (it holds a dot)."""
    with_scheme = F.concat(F.lit("/"), F.regexp_replace(url, r"^https?://[^/]*/?", ""))
    with_host_segment = F.concat(F.lit("/"), F.regexp_replace(url, r"^/[^/]*/?", ""))
    return (
        F.when(url.rlike(r"^https?://[^/]+\."), with_scheme)
        .when(url.rlike(r"^/[^/]+\."), with_host_segment)
        .otherwise(url)
    )


def strip_languages(url: Column, languages: Sequence[str]) -> Column:
    """Drop language prefixes, each at most once and in the order given.

    A path with a final slash loses one prefix and that slash, and nothing more; a path that starts with no
    offered language stays as it is.
    """
    if not languages:
        return url
    codes = [re.escape(language) for language in languages]
    one_prefix_and_slash = rf"(?s)^/(?:{'|'.join(codes)})(?=/)(.*)/\z"
    prefixes_in_order = "^/" + "".join(f"(?:{code}/)?" for code in codes)
    return F.when(url.endswith("/"), F.regexp_replace(url, one_prefix_and_slash, "$1")).otherwise(
        F.regexp_replace(url, prefixes_in_order, "/")
    )


def normalise_page_path(df: DataFrame, url_col: str, languages: Sequence[str]) -> DataFrame:
    """Replace ``url_col`` by the path without host and language."""
    return df.withColumn(url_col, strip_host(F.col(url_col))).withColumn(
        url_col, strip_languages(F.col(url_col), languages)
    )


def decode_plus(value: Column) -> Column:
    """URL-decode with ``+`` as a space; a per cent sign that starts no escape stays."""
    decoded = F.url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))
    # Most addresses have nothing to decode.
    return F.when(value.contains("%") | value.contains("+"), decoded).otherwise(value)


def repair_latin1(value: Column) -> Column:
    """Text that is UTF-8 read as Latin-1, put right; NULL where it is not that."""
    as_utf8 = F.try_validate_utf8(F.encode(value, "ISO-8859-1").cast("string"))
    is_ascii = F.octet_length(value) == F.length(value)
    return F.when(is_ascii, value).when(value.rlike(r"^[\x00-\xFF]*\z"), as_utf8)


def with_spellings(df: DataFrame, url_col: str, out_col: str) -> DataFrame:
    """Add the distinct spellings under which a file address may be stored in the catalogue, as an array.

    Tried are the address, without its final slash if it has one, each of these decoded, and each of these four
    with its charset repaired. A spelling that does not exist falls back to the address itself and so adds
    nothing. The steps are columns of their own so that each decoding and repair runs once per row.
    """
    url = F.col(url_col)
    plain, trimmed, decoded, decoded_trimmed = (f"__{out_col}_{i}" for i in range(4))
    repaired = {form: f"{form}_repaired" for form in (plain, trimmed, decoded, decoded_trimmed)}
    staged = (
        df.withColumns({plain: url, trimmed: F.when(url.endswith("/"), F.regexp_replace(url, r"/\z", ""))})
        .withColumns({decoded: decode_plus(F.col(plain)), decoded_trimmed: decode_plus(F.col(trimmed))})
        .withColumns({name: repair_latin1(F.col(form)) for form, name in repaired.items()})
    )
    forms = [plain, decoded, repaired[plain], repaired[decoded]]
    forms += [trimmed, decoded_trimmed, repaired[trimmed], repaired[decoded_trimmed]]
    candidates = F.array(*[F.coalesce(F.col(form), url) for form in forms])
    return staged.withColumn(out_col, F.array_distinct(candidates)).drop(*forms)


def spelling_root(url: Column) -> Column:
    """What an address has in common with every spelling that ``with_spellings`` gives it.

    Decoded until nothing changes, which takes at most a step per per cent sign and one more, without final slashes, and
    with one mark for each run of characters beyond ASCII: decoding, trimming and repairing change nothing else. Different
    addresses may share a root, so it says where to look and not what is equal.
    """
    steps = F.sequence(F.lit(0), F.length(url) - F.length(F.replace(url, F.lit("%"))))
    decoded = F.aggregate(steps, url, lambda value, _: decode_plus(value))
    plain = F.when(url.contains("%") | url.contains("+"), decoded).otherwise(url)
    is_ascii = F.octet_length(plain) == F.length(plain)
    return F.rtrim(F.when(is_ascii, plain).otherwise(F.regexp_replace(plain, r"[^\x00-\x7F]+", "?")), F.lit("/"))
