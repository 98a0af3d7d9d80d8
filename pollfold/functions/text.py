"""Text clean-up of answers, labels, user names and URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_image_markdown(text: Column) -> Column:
    """Drop a leading ``![name](url)`` tag.

    Text without ``[`` is returned unchanged. When the first word holds the ``[``, everything up to the
    first ``)`` goes. A ``[`` that only comes later is not a tag: the value is malformed and becomes null.
    """
    tail = F.regexp_extract(text, r"^[^)]*\)\s*((?s:.*))$", 1)
    return F.when(~F.contains(text, F.lit("[")), text).when(text.rlike(r"^\s*[^\s\[]*\["), tail)


def sanitise(text: Column) -> Column:
    """Canonical answer text: outer quotes, then outer spaces removed; lower case; no image tag."""
    return strip_image_markdown(F.lower(F.trim(F.btrim(text, F.lit("'")))))


def is_blank(text: Column) -> Column:
    """True for values made of spaces only (and for the empty string)."""
    return F.length(F.trim(text)) == 0


def underscored(text: Column) -> Column:
    return F.translate(text, " ", "_")


def in_user_list(name: Column, users: Iterable[str]) -> Column:
    """Case-insensitive membership in a short list of user names."""
    return F.lower(name).isin(sorted({u.lower() for u in users}))


def has_prefix(text: Column, prefix: str) -> Column:
    return F.startswith(text, F.lit(prefix))


def prefixed(text: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), text)


def without_extension(text: Column, extension: str = ".jpg") -> Column:
    return F.replace(text, F.lit(extension), F.lit(""))


def url_file_name(url: Column) -> Column:
    """Last path segment of a URL; null when the text is not a URL."""
    return F.substring_index(F.try_parse_url(url, F.lit("PATH")), "/", -1)


def rerooted(url: Column, root: str) -> Column:
    """File name of a URL below another folder."""
    return F.concat(F.lit(root.rstrip("/") + "/"), url_file_name(url))


def unhidden_key(key: Column) -> Column:
    """Metadata keys mark hidden fields with ``!`` at either end."""
    return F.btrim(key, F.lit("!"))
