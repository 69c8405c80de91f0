"""Job configuration for the driver queries over the supplied tables.

The registry names the archive sources of the ``archive`` view; keywords
are words that occur in the supplied (invented) text.  Targets follow a
rule on the data (a fraction of the rows) so the work grows with the
tables.
"""

from __future__ import annotations

from corpusforge.plans import sqltext as S

LABELS = ["Politics", "World", "Sports", "Economy"]
SEED = 42
# Keywords that occur in the invented text.
TEXT_KEYWORDS = ["worthless", "entis", "schen", "free", "eaux", "ment"]
FIRST_KW = ["ment", "free", "eaux"]
SECOND_KW = ["schen", "entis", "worthless", "MENT"]

REGISTRY = [
    {"name": "src1", "label": "Politics", "type": "wp_category", "pagination": "wp",
     "base_url": "https://src1.example.org/category/news/", "max_pages": 200000},
    {"name": "src3", "label": "World", "type": "wp_category", "pagination": "wp",
     "base_url": "https://src3.example.org/category/world//", "max_pages": 200000},
    {"name": "src5", "label": "World", "type": "wp_category", "pagination": "param",
     "base_url": "https://src5.example.org/list.php?page=", "max_pages": 200000},
    {"name": "src7", "label": "Sports", "type": "wp_category", "pagination": "wp",
     "base_url": "https://src7.example.org/sport", "start_page": 2, "max_pages": 200000},
    {"name": "src9", "label": "Sports", "type": "wp_category", "pagination": "wp",
     "base_url": "https://src9.example.org/ciyaaraha/", "max_pages": 6},
    {"name": "src11", "label": "Economy", "type": "keyword_archive", "pagination": "wp",
     "base_url": "https://src11.example.org/news/", "max_pages": 300000, "keywords": TEXT_KEYWORDS},
    {"name": "src13", "label": "Economy", "type": "keyword_archive", "pagination": "param",
     "base_url": "https://src13.example.org/archive.php?page=", "max_pages": 300000,
     "keywords": ["ment", "eaux"]},
    {"name": "src15", "label": "Economy", "type": "param_page", "pagination": "param",
     "base_url": "https://src15.example.org/p=", "max_pages": 300000, "keywords": TEXT_KEYWORDS},
    {"name": "src17", "label": "Economy", "type": "keyword_archive", "pagination": "wp",
     "base_url": "https://src17.example.org/", "max_pages": 300000, "keywords": []},
    {"name": "src19", "label": "Politics", "type": "wp_category", "pagination": "wp",
     "base_url": "https://src19.example.org/category/politics/", "max_pages": 200000},
]
# The sources of the whole listing: the archive's and the even-numbered ones.
ALL_SOURCES = REGISTRY + [
    {"name": f"src{i}", "label": LABELS[i // 2 % len(LABELS)], "type": "keyword_archive" if i % 4 else "wp_category",
     "pagination": "param" if i % 4 else "wp", "base_url": f"https://src{i}.example.org/all", "max_pages": 200000,
     "keywords": TEXT_KEYWORDS}
    for i in range(0, 20, 2)
]

# Sources of captured pages: two of the sites serve two labels, with selectors of
# their own.
PAGE_SOURCES = [
    {"name": "example.com", "label": "Politics", "base_url": "https://example.com/", "selectors": ["nav li a"], "max_pages": 2000000000},
    {"name": "example.com", "label": "World", "base_url": "https://example.com/", "selectors": [".entry-title", "article h1"],
     "max_pages": 2000000000},
    {"name": "example.org", "label": "Sports", "base_url": "https://example.org/", "selectors": ["h2 a", "li a"],
     "type": "keyword_archive", "keywords": TEXT_KEYWORDS, "max_pages": 2000000000},
    {"name": "example.org", "label": "Economy", "base_url": "https://example.org/", "selectors": ["article h1"],
     "max_pages": 2000000000},
    {"name": "example.net", "label": "Economy", "base_url": "https://example.net/", "selectors": ["nav a"], "max_pages": 2000000000},
]


def _site(domain: str, label: str, selectors: list[str], keywords: list[str] | None = None) -> dict:
    more = {} if keywords is None else {"type": "keyword_archive", "keywords": keywords}
    return {"name": f"example.{domain}", "label": label, "base_url": f"https://example.{domain}/", "selectors": selectors,
            "max_pages": 2000000000, **more}


# The top-ups on the captured pages: sources in order and their selectors.
# Titles are lower-cased before the test, so a keyword in capitals never fits.
TOPUP_SOURCES = {
    "topup_one_site": [_site("com", "Sports", ["li a"]), _site("com", "Economy", ["article h1"])],
    "topup_three_sites": [_site("com", "Economy", ["article h1", "li a"]), _site("net", "Economy", ["article h1", "li a"]),
                          _site("org", "Sports", ["article h1", "li a"])],
    "topup_keyword_site": [_site("com", "Sports", ["nav a"]), _site("org", "Sports", ["article h1"]),
                           _site("net", "Economy", ["article h1"], ["THE", "ment", "free"])],
    "topup_backup_site": [_site("com", "Sports", ["nav li a"]), _site("org", "Sports", ["article h1"])],
    "topup_categories_then_archive": [_site("com", "Economy", ["li a"]), _site("net", "Economy", ["li a"]),
                                      _site("org", "Economy", ["article h1"], TEXT_KEYWORDS)],
    "topup_archives": [_site(d, "Economy", ["article h1"], TEXT_KEYWORDS) for d in ("com", "org", "net")],
    "topup_two_archives": [_site("org", "Economy", ["article h1"], TEXT_KEYWORDS), _site("com", "Economy", ["nav a"], TEXT_KEYWORDS)],
}


def sql_registry(sources=None) -> str:
    """The registry as a DuckDB ``VALUES`` CTE named ``registry``."""
    from corpusforge.sources.registry import source_row

    rows = []
    for i, s in enumerate(REGISTRY if sources is None else sources):
        r = source_row(i + 1, s)
        sel = "[" + ", ".join(S.q(x) for x in r[8]) + "]::VARCHAR[]"
        kw = "[" + ", ".join(S.q(x) for x in r[9]) + "]::VARCHAR[]"
        rows.append(
            f"({r[0]}, {S.q(r[1])}, {S.q(r[2])}, {S.q(r[3])}, {S.q(r[4])}, {S.q(r[5])}, {r[6]}, {r[7]}, "
            f"{sel}, {kw}, {str(r[10]).upper()})"
        )
    return (
        "registry AS (SELECT CAST(priority AS INTEGER) AS priority, name, label, type, pagination, base_url, "
        "CAST(start_page AS INTEGER) AS start_page, CAST(max_pages AS INTEGER) AS max_pages, selectors, keywords, "
        "use_keyword_filter FROM (VALUES " + ",\n  ".join(rows) + ") t(priority, name, label, type, pagination, "
        "base_url, start_page, max_pages, selectors, keywords, use_keyword_filter))"
    )


def sql_labels(name: str = "req", labels=None) -> str:
    labels = LABELS if labels is None else labels
    vals = ", ".join(f"({i}, {S.q(l)})" for i, l in enumerate(labels))
    return f"{name} AS (SELECT CAST(label_pos AS BIGINT) AS label_pos, label FROM (VALUES {vals}) t(label_pos, label))"
