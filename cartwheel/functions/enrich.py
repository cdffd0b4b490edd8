"""Enrichments that need nothing but the row itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL parameter per marketing field, and parameters left out of fingerprints.
CAMPAIGN_PARAMETERS = {
    "medium": "utm_medium",
    "source": "utm_source",
    "term": "utm_term",
    "content": "utm_content",
    "campaign": "utm_campaign",
}
FINGERPRINT_EXCLUDES = ("cv", "eid", "nuid", "stm")


def url_parameter(url: Column, name: str) -> Column:
    raw = F.try_parse_url(url, F.lit("QUERY"), F.lit(name))
    return F.coalesce(F.try_url_decode(raw), raw)


def campaign(url: Column, parameters: Mapping[str, str] = CAMPAIGN_PARAMETERS) -> Column:
    """Struct of marketing fields, or null when the URL carries none."""
    fields = {n: url_parameter(url, p) for n, p in parameters.items()}
    some = F.coalesce(*fields.values()).isNotNull()
    return F.when(some, F.struct(*[c.alias(n) for n, c in fields.items()]))


def fingerprint(query: Column, excludes: Sequence[str] = FINGERPRINT_EXCLUDES) -> Column:
    """SHA-1 over the parameters of a query string, whatever their order, but for the excluded ones."""
    parts = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*excludes)
    )
    return F.sha1(F.array_join(F.array_sort(parts), "&"))


def pseudonym(field: Column, salt: str) -> Column:
    return F.sha1(F.concat(field, F.lit(salt)))


def anonymous_ip(ip: Column, octets: int = 1) -> Column:
    """IPv4 with its last octets replaced by ``x``; other text stays as it is."""
    kept = r"(\d+)" + r"\.(\d+)" * (3 - octets)
    pattern = "^" + kept + r"\.\d+" * octets + "$"
    keep = ".".join(f"${i}" for i in range(1, 5 - octets))
    return F.regexp_replace(ip, pattern, keep + ".x" * octets)


def ip_number(ip: Column) -> Column:
    """IPv4 text as a number, null for anything else, octets above 255 included.

    The text occurs twice here: filters and join keys work out an expression anew wherever it occurs.
    """
    octet = lambda o: o.try_cast("long")
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("long"), lambda n, o: n * 256 + F.when(octet(o) <= 255, octet(o)))
    return F.when(ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), number)
