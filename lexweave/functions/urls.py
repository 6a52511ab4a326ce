"""URI and URL functions. All take a column or column name and keep null as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_uri(uri: Column | str) -> Column:
    """One spelling per resource: no surrounding blanks, http for https, lower-case scheme and host, ``/id/`` as ``/``,
    and no final ``/data.xml`` or ``/``. A blank uri becomes the empty string."""
    u = F.regexp_replace(_col(uri), r"^\s+|\s+$", "")
    authority = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)", 1)
    u = F.concat(F.regexp_replace(F.lower(authority), r"^https://", "http://"), u.substr(F.length(authority) + 1, F.length(u)))
    return F.regexp_replace(F.replace(u, F.lit("/id/"), F.lit("/")), r"(?:/data\.xml)?/?$", "")


def fetch_url(url: Column | str) -> Column:
    """The URL a record is fetched from: ``/id/`` dropped, trailing slashes cut, ``/data.xml`` appended unless the URL
    already ends in ``data.xml``. Null and empty give null."""
    c = _col(url)
    u = F.rtrim(F.replace(c, F.lit("/id/"), F.lit("/")), F.lit("/"))
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).when(u.endswith("data.xml"), u).otherwise(F.concat(u, F.lit("/data.xml")))


def plain_url(url: Column | str) -> Column:
    """``/id/`` read as ``/`` and trailing slashes cut."""
    return F.rtrim(F.replace(_col(url), F.lit("/id/"), F.lit("/")), F.lit("/"))


def file_name(url: Column | str, prefix: str) -> Column:
    """A flat file name: scheme and ``prefix`` removed, ``/`` written as ``_``."""
    rest = F.element_at(F.split(_col(url), "://"), -1)
    return F.replace(F.replace(rest, F.lit(prefix), F.lit("")), F.lit("/"), F.lit("_"))


def act_of_section_uri(uri: Column | str) -> Column:
    """The act a section-level ``/id/`` uri belongs to; other uris stay as they are."""
    return F.regexp_replace(_col(uri), r"^(https?://[^/]+)/id/([^/]+/[0-9]+/[0-9]+).*$", "$1/$2")
