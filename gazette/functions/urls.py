"""URL parts and article identity (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions.text import null_if_blank

# Pattern rather than parse_url: that one drops the port and fails on bad input.
_AUTHORITY = r"(?i)^https?://([^/?#]*)"
_PATH = r"(?i)^https?://[^/?#]*([^?#]*)"


def article_id(canonical_url: Column, url: Column) -> Column:
    """First hex digits of the SHA-256 of the stable URL."""
    stable = F.coalesce(null_if_blank(canonical_url), url)
    return F.substring(F.sha2(stable, 256), 1, C.ARTICLE_ID_CHARS)


def has_web_scheme(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def host(url: Column) -> Column:
    """Authority part in lower case, with port and user info."""
    return F.lower(F.regexp_extract(url, _AUTHORITY, 1))


def path(url: Column) -> Column:
    """Path in lower case; parameters of the last segment are cut off."""
    whole = F.regexp_extract(url, _PATH, 1)
    return F.lower(F.regexp_replace(whole, r";[^/]*\z", ""))


_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_LAST_AS_IPV4 = rf"^(.*:)(?:{_OCTET}\.){{3}}{_OCTET}$"


def _is_ipv6(address: Column) -> Column:
    """Eight groups, or fewer around one "::"; the last two may be an IPv4 address.

    A zone behind "%" is anything but empty, without another "%".
    """
    bare = F.regexp_replace(address, "%[^%]+$", "")
    groups = F.regexp_replace(bare, _LAST_AS_IPV4, "$10:0")
    run = f"(?:{_HEX}(?::{_HEX})*)?"
    whole = groups.rlike(f"^(?:{_HEX}:){{7}}{_HEX}$")
    short = groups.rlike(f"^{run}::{run}$") & (F.size(F.regexp_extract_all(groups, F.lit(_HEX), F.lit(0))) <= 7)
    return whole | short


def has_broken_host(url: Column) -> Column:
    """Brackets that do not hold an IPv6 address or a later kind ("v1.x").

    They come in a pair, at the start of the host, and only a port may follow.
    """
    authority = F.regexp_extract(url, _AUTHORITY, 1)
    opened, closed = (F.contains(authority, F.lit(c)) for c in "[]")
    place = r"^(?:.*@)?\[([^\[\]]*)\](?::.*)?$"
    inner = F.regexp_extract(authority, place, 1)
    sound = authority.rlike(place) & (_is_ipv6(inner) | inner.rlike(r"^v[0-9A-Fa-f]+\..+$"))
    return F.when(opened | closed, ~sound).otherwise(False)
