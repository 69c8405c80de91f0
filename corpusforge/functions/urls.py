"""Crawl-frontier URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wp_page_url(base: Column | str, page: Column | str) -> Column:
    """Trailing slashes folded to one; page 1 -> base, N -> base/page/N/."""
    b = F.concat(F.regexp_replace(_c(base), "/+$", ""), F.lit("/"))
    p = _c(page)
    return F.when(p == 1, b).otherwise(F.concat(b, F.lit("page/"), p.cast("string"), F.lit("/")))


def suffixed_page_url(base: Column | str, page: Column | str) -> Column:
    """Base already ends in ``/page/``; ``base + N + '/'`` also for page 1."""
    return F.concat(_c(base), _c(page).cast("string"), F.lit("/"))


def param_page_url(base: Column | str, page: Column | str) -> Column:
    """C4: ``base + str(page)``."""
    return F.concat(_c(base), _c(page).cast("string"))


def page_url(mode: Column | str, base: Column | str, page: Column | str) -> Column:
    """Dispatch on the pagination mode; an unknown mode fails the job."""
    m = _c(mode)
    return (
        F.when(m == "wp", wp_page_url(base, page))
        .when(m == "param", param_page_url(base, page))
        .when(m == "suffixed", suffixed_page_url(base, page))
        .otherwise(F.raise_error(F.concat(F.lit("Unknown pagination mode: "), F.coalesce(m, F.lit("null")))))
    )


def label_from_key(key: Column | str, marker: str = "Sports") -> Column:
    """``'Sports' if 'Sports' in key else key``."""
    k = _c(key)
    return F.when(k.contains(marker), F.lit(marker)).otherwise(k)
