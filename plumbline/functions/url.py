"""URL canonicalisation as one native expression.

Rejected (null): white space, schemes other than http and https, no host, user info, a bad port.
Scheme and host are lower-cased, default port and fragment dropped, an empty path becomes "/";
tracking parameters go, every other byte of the query stays in place and order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only track.
TRACKING = ("dclid", "fbclid", "gclid", "mc_cid", "mc_eid", "msclkid")
TRACKING_PREFIX = "utm_"
_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _SHAPE, k)


def is_tracking(segment: Column) -> Column:
    name = F.element_at(F.split(segment, "=", 2), 1)
    name = F.lower(F.coalesce(F.try_url_decode(name), name))  # an invalid escape is taken literally
    return name.startswith(TRACKING_PREFIX) | name.isin(*TRACKING)


def without_tracking(query: Column) -> Column:
    """A query string (without "?") less its tracking parameters."""
    return F.array_join(F.filter(F.split(query, "&", -1), lambda s: ~is_tracking(s)), "&")


def canonicalize(url: Column) -> Column:
    scheme, authority, path, query = F.lower(_part(url, 1)), F.lower(_part(url, 2)), _part(url, 3), _part(url, 4)
    port = F.regexp_extract(authority, r":(\d*)$", 1)
    host = F.regexp_replace(authority, r":\d*$", "")
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    kept = without_tracking(F.substring(query, 2, 1 << 30))
    valid = url.isNotNull() & ~url.rlike(r"[\s\u0085   　]") & scheme.isin("http", "https") & (host != "") & ~authority.contains("@")
    valid &= host.rlike(r"^(\[[0-9a-f:.]+\]|[^:\[\]]+)$") & ((port == "") | (F.coalesce(port.try_cast("int"), F.lit(-1)).between(0, 65535)))
    return F.when(valid, F.concat(scheme, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def host_of(canonical: Column) -> Column:
    return F.regexp_extract(canonical, r"^[a-z]+://([^/:?#]+)", 1)


def path_for_matching(canonical: Column) -> Column:
    """The path with a slash at its end, so that prefixes match whole segments."""
    path = F.regexp_extract(canonical, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))
