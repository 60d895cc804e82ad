"""Archive keys: content hashes, file extensions and dedup pointers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extension by declared type, used when the URL has none.
TYPE_EXTENSIONS = {
    "pdf": ".pdf",
    "audio": ".mp3",
    "mp3": ".mp3",
    "wav": ".wav",
    "image": ".jpg",
    "jpg": ".jpg",
    "jpeg": ".jpg",
    "png": ".png",
    "gif": ".gif",
    "html": ".html",
    "json": ".json",
    "xml": ".xml",
    "text": ".txt",
    "csv": ".csv",
}

# URL schemes whose last path part may carry ";parameters".
PARAM_SCHEMES = (
    "",
    "ftp",
    "hdl",
    "http",
    "https",
    "imap",
    "mms",
    "prospero",
    "rtsp",
    "rtsps",
    "rtspu",
    "sftp",
    "shttp",
    "sip",
    "sips",
    "tel",
)

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_path(url: Column) -> Column:
    """Path of a URL, without query, fragment and parameters of the last part.

    ``parse_url`` is no substitute: it gives NULL for URLs with spaces.
    """
    clean = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    scheme = F.lower(F.regexp_extract(clean, _SCHEME, 1))
    path = F.regexp_extract(clean, _PATH, 1)
    return F.when(
        scheme.isin(*PARAM_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")
    ).otherwise(path)


def file_extension(url: Column, expected_type: Column) -> Column:
    """Lower-cased suffix of the URL's file name, else the one of the declared type, else ''."""
    trimmed = F.regexp_replace(url_path(url), r"(?:/+\.?(?=/|$))+$", "")
    name = F.regexp_extract(trimmed, r"([^/]*)$", 1)
    suffix = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    by_type = F.create_map(*[F.lit(x) for x in chain.from_iterable(TYPE_EXTENSIONS.items())])
    return F.when(F.coalesce(suffix, F.lit("")) != "", suffix).otherwise(
        F.coalesce(F.try_element_at(by_type, F.lower(expected_type)), F.lit(""))
    )


def content_sha(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def content_key(prefix: Column, sha: Column, extension: Column) -> Column:
    """``{prefix}{first two}/{next two}/{sha}{extension}``."""
    return F.concat(
        prefix, F.substring(sha, 1, 2), F.lit("/"), F.substring(sha, 3, 2), F.lit("/"), sha, extension
    )


def dedup_pointer_key(prefix: Column, deduplication_key: Column) -> Column:
    return F.concat(prefix, F.lit("_dedup/"), content_sha(deduplication_key))


def has_key(deduplication_key: Column) -> Column:
    """An empty key counts as no key."""
    return F.coalesce(deduplication_key, F.lit("")) != ""
