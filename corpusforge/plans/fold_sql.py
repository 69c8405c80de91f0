"""DuckDB oracle for the collection fold: one CTE chain per (label, source)
step, written from the same job configuration as the Spark run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from corpusforge.operators.collect import CollectConfig
from corpusforge.plans import fixtures as FX
from corpusforge.plans import sqltext as S
from corpusforge.plans import views as V
from corpusforge.sources.registry import source_row

NO_QUOTA = "CAST(9000000000000000000 AS BIGINT)"


def _apply_kw(src: Mapping) -> bool:
    return src.get("type", "wp_category") == "keyword_archive" or bool(src.get("use_keyword_filter", False))


def steps(registry: Sequence[Mapping], labels: Sequence[str]) -> list[tuple[int, str, Mapping]]:
    """Static step numbering: labels in order, sources by priority."""
    out = []
    for l in labels:
        for s in registry:
            if s["label"] == l:
                out.append((len(out) + 1, l, s))
    return out


def fold_sql(
    labels: Sequence[str],
    registry: Sequence[Mapping] = FX.REGISTRY,
    cfg: CollectConfig = CollectConfig(),
    quota: bool = True,
    target_div: int = 5,
    tail: str = "accepted",
    captured: str | None = None,
    corpus: str = "base",
) -> str:
    """``tail``: ``accepted`` rows, ``metrics`` per step, ``corpus`` (K1:
    base ∪ accepted, keep-first by normalised text) or ``shortfall`` (A13).
    ``captured``: CTEs that define ``archive`` and ``page_status`` anew;
    ``corpus``: the view that is extended."""
    reg_sql = _registry_sql(registry)
    stop = []
    if cfg.stop_on_http:
        stop.append("(st IS NOT NULL AND st <> 200)")
    if cfg.stop_on_empty:
        stop.append("(st = 200 AND n = 0)")
    stop_expr = " OR ".join(stop) if stop else "FALSE"
    if cfg.dedupe_in_page:
        kept = ("kept AS (SELECT source, page_no, pos, title, href FROM (SELECT *, row_number() OVER "
                "(PARTITION BY source, page_no, title, href ORDER BY pos) AS _d FROM archive "
                f"WHERE length(title) >= {cfg.min_title_len}) WHERE _d = 1)")
    else:
        kept = f"kept AS (SELECT source, page_no, pos, title, href FROM archive WHERE length(title) >= {cfg.min_title_len})"
    if cfg.empty_test == "long_enough":
        counted = "kept"
    elif cfg.empty_test == "raw":
        counted = "archive"
    else:
        counted = ("(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, page_no, title, href "
                   "ORDER BY pos) AS _d FROM archive) WHERE _d = 1)")
    ctes = [
        V.with_views(corpus, *([] if captured else ["archive", "page_status"]))[len("WITH "):],
        *([captured] if captured else []),
        S.clean_cte(corpus, "cbase"),
        FX.sql_labels("req", labels),
        f"tgt AS (SELECT count(*) // {target_div} AS target FROM cbase)",
        "needs AS (SELECT req.label, CAST(greatest(0, tgt.target - coalesce(c.have, 0)) AS BIGINT) AS need "
        "FROM req LEFT JOIN (SELECT label, count(*) AS have FROM cbase GROUP BY label) c ON req.label = c.label, tgt)",
        reg_sql,
        kept,
        f"pcnt AS (SELECT source, page_no, count(*) AS n_items FROM {counted} GROUP BY source, page_no)",
        "pp AS (SELECT ps.source, ps.page_no, ps.http_status AS st, coalesce(pcnt.n_items, 0) AS n "
        "FROM page_status ps JOIN registry r ON ps.source = r.name AND ps.page_no BETWEEN r.start_page AND r.max_pages "
        "LEFT JOIN pcnt ON pcnt.source = ps.source AND pcnt.page_no = ps.page_no)",
        f"pp2 AS (SELECT *, max(CASE WHEN {stop_expr} THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY page_no "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM pp)",
        "vis AS (SELECT source, page_no, row_number() OVER (PARTITION BY source ORDER BY page_no) AS ord "
        "FROM pp2 WHERE stopped = 0 AND st = 200)",
        f"seen0 AS (SELECT DISTINCT {S.norm('text')} AS norm FROM cbase)",
        f"cand0 AS (SELECT k.source, k.page_no, k.pos, k.title AS text, k.href AS url, {S.norm('k.title')} AS norm "
        "FROM kept k WHERE EXISTS (SELECT 1 FROM vis WHERE vis.source = k.source AND vis.page_no = k.page_no))",
        "cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, norm ORDER BY page_no, pos) AS _f "
        "FROM cand0 WHERE norm NOT IN (SELECT norm FROM seen0)) WHERE _f = 1)",
    ]
    st = steps(registry, labels)
    prev_by_label: dict[str, int] = {}
    for i, label, src in st:
        name = src["name"]
        kw = list(src.get("keywords") or [])
        kw_cond = S.any_contains("norm", kw) if (_apply_kw(src) and cfg.apply_keyword_filter and kw) else "TRUE"
        prior = " AND norm NOT IN (SELECT norm FROM accn%d)" % i if i > 1 else ""
        if i > 1:
            ctes.append(
                f"accn{i} AS (SELECT norm FROM acc{i - 1}" + (f" UNION ALL SELECT norm FROM accn{i - 1}" if i > 2 else "") + ")"
            )
        ctes.append(f"c{i} AS (SELECT * FROM cand WHERE source = {S.q(name)} AND {kw_cond}{prior})")
        ctes.append(
            f"g{i} AS (SELECT v.page_no, v.ord, coalesce(x.added, 0) AS added FROM vis v LEFT JOIN "
            f"(SELECT page_no, count(*) AS added FROM c{i} GROUP BY page_no) x ON x.page_no = v.page_no "
            f"WHERE v.source = {S.q(name)})"
        )
        k = cfg.k_for(name)
        streak_cut = (
            f"coalesce(max(CASE WHEN streak >= {k} THEN 1 ELSE 0 END) OVER (ORDER BY page_no ROWS BETWEEN "
            "UNBOUNDED PRECEDING AND 1 PRECEDING), 0)" if k is not None else "0"
        )
        ctes.append(
            f"h{i} AS (SELECT *, coalesce(sum(added) OVER (ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND "
            "1 PRECEDING), 0) AS before, ord - max(CASE WHEN added > 0 THEN ord ELSE 0 END) OVER (ORDER BY page_no "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM g{i})"
        )
        ctes.append(f"p{i} AS (SELECT *, {streak_cut} AS cut FROM h{i})")
        if not quota:
            rem = NO_QUOTA
        elif label in prev_by_label:
            j = prev_by_label[label]
            rem = f"(SELECT rem FROM r{j}) - (SELECT count(*) FROM acc{j})"
        else:
            rem = f"coalesce((SELECT need FROM needs WHERE label = {S.q(label)}), 0)"
        prev_by_label[label] = i
        ctes.append(f"r{i} AS (SELECT CAST({rem} AS BIGINT) AS rem)")
        ctes.append(
            f"acc{i} AS (SELECT CAST({i} AS INTEGER) AS step, {S.q(name)} AS source, {S.q(label)} AS label, "
            "c.page_no, c.pos, c.text, c.url, c.norm FROM (SELECT *, row_number() OVER (PARTITION BY page_no "
            f"ORDER BY pos) AS rk FROM c{i}) c JOIN p{i} ON p{i}.page_no = c.page_no, r{i} "
            f"WHERE p{i}.cut = 0 AND p{i}.before < r{i}.rem AND p{i}.before + c.rk <= r{i}.rem)"
        )
        ctes.append(
            f"m{i} AS (SELECT CAST({i} AS INTEGER) AS step, {S.q(name)} AS source, {S.q(label)} AS label, "
            f"(SELECT count(*) FROM p{i}, r{i} WHERE p{i}.cut = 0 AND p{i}.before < r{i}.rem) AS pages_visited, "
            f"(SELECT count(*) FROM acc{i}) AS added, (SELECT rem FROM r{i}) AS rem)"
        )
        ctes.append(
            f"pm{i} AS (SELECT CAST({i} AS INTEGER) AS step, {S.q(name)} AS source, {S.q(label)} AS label, "
            f"p{i}.page_no, CAST(least(p{i}.added, r{i}.rem - p{i}.before) AS BIGINT) AS added, "
            f"CAST(p{i}.before + least(p{i}.added, r{i}.rem - p{i}.before) AS BIGINT) AS running_total, r{i}.rem "
            f"FROM p{i}, r{i} WHERE p{i}.cut = 0 AND p{i}.before < r{i}.rem)"
        )
    if st:
        ctes.append("accall AS (" + " UNION ALL ".join(f"SELECT * FROM acc{i}" for i, _, _ in st) + ")")
        ctes.append("mall AS (" + " UNION ALL ".join(f"SELECT * FROM m{i}" for i, _, _ in st) + ")")
        ctes.append("pmall AS (" + " UNION ALL ".join(f"SELECT * FROM pm{i}" for i, _, _ in st) + ")")
    else:
        ctes.append("accall AS (SELECT CAST(NULL AS INTEGER) AS step, '' AS source, '' AS label, CAST(NULL AS BIGINT) "
                    "AS page_no, CAST(NULL AS BIGINT) AS pos, '' AS text, '' AS url, '' AS norm WHERE FALSE)")
        ctes.append("mall AS (SELECT 1 AS step WHERE FALSE)")
    head = "WITH " + ",\n".join(ctes) + "\n"
    if tail == "accepted":
        return head + "SELECT step, source, label, page_no, pos, text, url FROM accall"
    if tail == "page_metrics":
        return head + "SELECT step, source, label, page_no, added, running_total FROM pmall WHERE rem > 0"
    if tail == "metrics":
        return head + "SELECT step, source, label, pages_visited, added FROM mall WHERE rem > 0"
    if tail == "corpus":
        return head + (
            "SELECT part_no, row_id, step, page_no, pos, text, label, source, url FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY {S.norm('text')} ORDER BY part_no, row_id NULLS FIRST, "
            "step NULLS FIRST, page_no NULLS FIRST, pos NULLS FIRST) AS _k FROM ("
            "SELECT CAST(0 AS INTEGER) AS part_no, row_id, CAST(NULL AS INTEGER) AS step, CAST(NULL AS BIGINT) AS page_no, "
            "CAST(NULL AS BIGINT) AS pos, text, label, source, url FROM cbase UNION ALL "
            "SELECT CAST(1 AS INTEGER), CAST(NULL AS BIGINT), step, page_no, pos, text, label, source, url FROM accall"
            ")) WHERE _k = 1"
        )
    if tail == "shortfall":
        return head.rstrip("\n") + ",\n" + (
            "fin AS (SELECT label FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{S.norm('text')} ORDER BY part_no, row_id NULLS FIRST, step NULLS FIRST, page_no NULLS FIRST, "
            "pos NULLS FIRST) AS _k FROM (SELECT 0 AS part_no, row_id, CAST(NULL AS INTEGER) AS step, "
            "CAST(NULL AS BIGINT) AS page_no, CAST(NULL AS BIGINT) AS pos, text, label FROM cbase UNION ALL "
            "SELECT 1, CAST(NULL AS BIGINT), step, page_no, pos, text, label FROM accall)) WHERE _k = 1)\n"
            "SELECT req.label_pos, req.label, CAST(coalesce(c.have, 0) AS BIGINT) AS have, "
            "CAST(greatest(0, tgt.target - coalesce(c.have, 0)) AS BIGINT) AS need FROM req LEFT JOIN "
            "(SELECT label, count(*) AS have FROM fin GROUP BY label) c ON req.label = c.label, tgt "
            "WHERE tgt.target - coalesce(c.have, 0) > 0"
        )
    raise ValueError(tail)


def _registry_sql(registry: Sequence[Mapping]) -> str:
    rows = []
    for i, s in enumerate(registry):
        r = source_row(i + 1, s)
        rows.append(f"({r[0]}, {S.q(r[1])}, {S.q(r[2])}, {r[6]}, {r[7]})")
    return ("registry AS (SELECT CAST(priority AS INTEGER) AS priority, name, label, CAST(start_page AS BIGINT) AS start_page, "
            "CAST(max_pages AS BIGINT) AS max_pages FROM (VALUES " + ", ".join(rows)
            + ") t(priority, name, label, start_page, max_pages))")
