"""ANSI SQL for every query that SQL can express, written from the definitions and not from the jobs.

A query names the common tables it needs; ``_sql`` puts them, and what they need in turn, in front.
"""

from __future__ import annotations

import re

_COMMON = {
    "fx_dim": """
        SELECT CASE WHEN p_partkey % 10 = 0 THEN concat('X', CAST(p_partkey AS VARCHAR)) ELSE CAST(p_partkey AS VARCHAR) END AS product_code, p_name AS device_name,
               CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN '' ELSE p_brand END AS review_panel,
               CAST(p_size % 3 + 1 AS VARCHAR) AS device_class, p_type AS medical_specialty_description
        FROM part""",
    "fx_events": """
        SELECT concat(CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS event_record_id,
               CAST(l_orderkey AS VARCHAR) AS mdr_report_key, CAST(l_shipdate AS DATE) AS date_received,
               CAST(year(l_shipdate) AS INTEGER) AS event_year,
               CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS product_code,
               s_name AS manufacturer_d_name, l_returnflag = 'R' AS has_death, l_returnflag = 'A' AS has_serious_injury,
               l_linestatus = 'F' AS has_malfunction, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
               row_number() OVER w AS followup_rank, row_number() OVER w = 1 AS is_latest_version
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)""",
    "fx_recalls": """
        SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS recall_number,
               CAST(l_shipdate AS DATE) AS recall_initiation_date, CAST(year(l_shipdate) AS INTEGER) AS recall_year,
               CASE l_linenumber % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'II' ELSE 'III' END AS recall_class,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS product_code,
               CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey AS VARCHAR) END AS matched_product_code,
               s_name AS recalling_firm, l_returnflag = 'R' AND l_discount >= 0.05 AND l_tax <= 0.06 AS include_in_core_dashboard,
               CASE l_partkey % 5 WHEN 0 THEN 'exact_product_code_match' WHEN 1 THEN 'high_confidence_text_match'
                    WHEN 2 THEN 'low_confidence_text_match' ELSE 'unmapped' END AS mapping_quality
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "fx_clearances": """
        SELECT CAST(o_orderkey AS VARCHAR) AS k_number, CAST(o_orderdate AS DATE) AS decision_date,
               CAST(year(o_orderdate) AS INTEGER) AS decision_year, CAST(l_partkey AS VARCHAR) AS product_code,
               o_orderpriority AS decision_code
        FROM (SELECT l_orderkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1) JOIN orders ON l_orderkey = o_orderkey""",
    "fx_companies": """
        SELECT s_suppkey, concat(s_name, CASE CAST(s_suppkey % 5 AS INT) WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC'
               WHEN 2 THEN ' Holdings  Group Ltd' WHEN 3 THEN ' GmbH & Co' ELSE '' END) AS company FROM supplier""",
    # Marts by outer joins of three separate aggregates.
    "ev_panel": """
        SELECT d.review_panel, e.event_year AS year, count(*) AS event_count_raw,
               count(*) FILTER (WHERE e.is_latest_version) AS event_count_dedup,
               count(*) FILTER (WHERE e.has_death) AS death_related_reports,
               count(*) FILTER (WHERE e.has_serious_injury) AS serious_injury_reports,
               count(*) FILTER (WHERE e.has_malfunction) AS malfunction_reports
        FROM fx_events e JOIN fx_dim d ON e.product_code = d.product_code
        WHERE d.review_panel IS NOT NULL GROUP BY 1, 2""",
    "rc_panel": """
        SELECT d.review_panel, r.recall_year AS year, count(*) AS recall_count,
               count(*) FILTER (WHERE r.recall_class = 'I') AS class_i_recall_count,
               count(*) FILTER (WHERE r.recall_class = 'II') AS class_ii_recall_count,
               count(*) FILTER (WHERE r.recall_class = 'III') AS class_iii_recall_count
        FROM fx_recalls r JOIN fx_dim d ON coalesce(r.matched_product_code, r.product_code) = d.product_code
        WHERE r.include_in_core_dashboard AND d.review_panel IS NOT NULL GROUP BY 1, 2""",
    "cl_panel": """
        SELECT d.review_panel, c.decision_year AS year, count(*) AS clearance_count
        FROM fx_clearances c JOIN fx_dim d ON c.product_code = d.product_code
        WHERE d.review_panel IS NOT NULL GROUP BY 1, 2""",
    "panel_keys": """
        SELECT review_panel, year FROM ev_panel UNION SELECT review_panel, year FROM rc_panel UNION SELECT review_panel, year FROM cl_panel""",
    "panel_counts": """
        SELECT k.review_panel, k.year, coalesce(event_count_raw, 0) AS event_count_raw, coalesce(event_count_dedup, 0) AS event_count_dedup,
               coalesce(death_related_reports, 0) AS death_related_reports, coalesce(serious_injury_reports, 0) AS serious_injury_reports,
               coalesce(malfunction_reports, 0) AS malfunction_reports, coalesce(recall_count, 0) AS recall_count,
               coalesce(class_i_recall_count, 0) AS class_i_recall_count, coalesce(class_ii_recall_count, 0) AS class_ii_recall_count,
               coalesce(class_iii_recall_count, 0) AS class_iii_recall_count, coalesce(clearance_count, 0) AS clearance_count
        FROM panel_keys k LEFT JOIN ev_panel e USING (review_panel, year) LEFT JOIN rc_panel r USING (review_panel, year)
             LEFT JOIN cl_panel c USING (review_panel, year) WHERE k.year BETWEEN 1996 AND 2000""",
    "m_panel": "SELECT *, {panel_kpis_10_3} FROM panel_counts",
    "m_panel_guarded": "SELECT *, {panel_kpis_60_12} FROM panel_counts",
    "ev_product": """
        SELECT product_code, event_year AS year, count(*) FILTER (WHERE is_latest_version) AS event_count_dedup
        FROM fx_events GROUP BY 1, 2""",
    "rc_product": """
        SELECT coalesce(matched_product_code, product_code) AS product_code, recall_year AS year, count(*) AS recall_count,
               count(*) FILTER (WHERE recall_class = 'I') AS class_i_recall_count
        FROM fx_recalls WHERE include_in_core_dashboard GROUP BY 1, 2""",
    "cl_product": "SELECT product_code, decision_year AS year, count(*) AS clearance_count FROM fx_clearances GROUP BY 1, 2",
    "product_keys": """
        SELECT product_code, year FROM ev_product UNION SELECT product_code, year FROM rc_product UNION SELECT product_code, year FROM cl_product""",
    "product_base": """
        SELECT k.product_code, k.year, coalesce(e.event_count_dedup, 0) AS event_count_dedup, coalesce(r.recall_count, 0) AS recall_count,
               coalesce(r.class_i_recall_count, 0) AS class_i_recall_count, coalesce(c.clearance_count, 0) AS clearance_count
        FROM product_keys k
        LEFT JOIN ev_product e ON k.product_code IS NOT DISTINCT FROM e.product_code AND k.year = e.year
        LEFT JOIN rc_product r ON k.product_code IS NOT DISTINCT FROM r.product_code AND k.year = r.year
        LEFT JOIN cl_product c ON k.product_code IS NOT DISTINCT FROM c.product_code AND k.year = c.year
        WHERE k.year BETWEEN 1996 AND 2000""",
    "m_product": "SELECT *, {product_kpis_10_3} FROM product_base",
    "ev_firm": """
        SELECT manufacturer_d_name AS manufacturer, product_code, event_year AS year,
               count(*) FILTER (WHERE is_latest_version) AS event_count_dedup
        FROM fx_events WHERE event_year BETWEEN 1996 AND 2000 GROUP BY 1, 2, 3""",
    "rc_firm": """
        SELECT recalling_firm AS manufacturer, coalesce(matched_product_code, product_code) AS product_code, recall_year AS year,
               count(*) AS recall_count, count(*) FILTER (WHERE recall_class = 'I') AS severe_recall_count
        FROM fx_recalls WHERE include_in_core_dashboard AND recall_year BETWEEN 1996 AND 2000 GROUP BY 1, 2, 3""",
    "firm_keys": "SELECT manufacturer, product_code, year FROM ev_firm UNION SELECT manufacturer, product_code, year FROM rc_firm",
    "firm_base": """
        SELECT k.manufacturer, k.product_code, k.year, coalesce(e.event_count_dedup, 0) AS event_count_dedup,
               coalesce(r.recall_count, 0) AS recall_count, coalesce(r.severe_recall_count, 0) AS severe_recall_count
        FROM firm_keys k
        LEFT JOIN ev_firm e ON k.manufacturer = e.manufacturer AND k.product_code IS NOT DISTINCT FROM e.product_code AND k.year = e.year
        LEFT JOIN rc_firm r ON k.manufacturer = r.manufacturer AND k.product_code IS NOT DISTINCT FROM r.product_code AND k.year = r.year""",
    "firm_shares": """
        SELECT f.*, d.review_panel,
               CASE WHEN f.product_code IS NOT NULL AND sum(event_count_dedup) OVER (PARTITION BY f.product_code, year) > 0
                    THEN CAST(event_count_dedup AS DOUBLE) / CAST(sum(event_count_dedup) OVER (PARTITION BY f.product_code, year) AS DOUBLE) END AS firm_share_within_product,
               CASE WHEN d.review_panel IS NOT NULL AND sum(event_count_dedup) OVER (PARTITION BY d.review_panel, year) > 0
                    THEN CAST(event_count_dedup AS DOUBLE) / CAST(sum(event_count_dedup) OVER (PARTITION BY d.review_panel, year) AS DOUBLE) END AS firm_share_within_panel
        FROM firm_base f LEFT JOIN fx_dim d ON f.product_code = d.product_code""",
    "m_firm": """
        SELECT manufacturer, product_code, year, CAST(event_count_dedup AS BIGINT) AS event_count_dedup, recall_count, severe_recall_count,
               firm_share_within_product, firm_share_within_panel FROM firm_shares""",
    # Raw records.
    "raw_events": """
        SELECT CAST(l_orderkey AS VARCHAR) AS mdr_report_key, l_suppkey, l_partkey * 10 + l_linenumber AS pos,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS day,
               CASE WHEN l_linenumber = 7 THEN 'BADDATE' ELSE strftime(l_shipdate, '%Y%m%d') END AS raw_date,
               CASE WHEN l_discount = 0 THEN '' WHEN l_linestatus = 'F' THEN 'Malfunction' ELSE 'Injury' END AS event_type,
               CASE WHEN l_suppkey % 7 = 0 OR l_suppkey % 11 = 0 THEN '' WHEN l_suppkey % 2 = 0 THEN 'Company' ELSE 'User' END AS source_type,
               l_tax > 0.04 AS remedial_action_flag,
               CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END AS adverse_event_flag,
               l_returnflag = 'R' AS has_death, l_returnflag = 'A' AS has_serious_injury,
               l_linenumber % 3 AS devices, l_returnflag, s_name, l_quantity, l_partkey
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "raw_devices": """
        SELECT r.*, i.i AS device_index, concat(mdr_report_key, '_', CAST(i.i AS VARCHAR)) AS event_record_id,
               CASE WHEN i.i = 0 AND l_quantity <> 1 THEN CAST(l_partkey AS VARCHAR) END AS product_code,
               CASE WHEN i.i = 0 THEN l_returnflag END AS brand_name, CASE WHEN i.i = 1 THEN 'second' END AS generic_name,
               CASE WHEN i.i = 0 THEN s_name END AS manufacturer_d_name
        FROM raw_events r JOIN (VALUES (0), (1)) i(i) ON i.i < r.devices""",
    "raw_recalls": """
        SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS recall_number, l_suppkey,
               l_partkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS pos,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS day, l_linenumber, l_linestatus, s_name, l_partkey
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "code_lookup": """
        SELECT product_res_number, product_code FROM (
            SELECT recall_number AS product_res_number, concat('P', CAST(l_partkey AS VARCHAR)) AS product_code,
                   row_number() OVER (PARTITION BY recall_number ORDER BY l_suppkey DESC, pos DESC) AS n
            FROM raw_recalls WHERE l_partkey % 5 <> 0) WHERE n = 1""",
    "descriptions": """
        SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS recall_number, l_orderkey,
               CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) WHEN l_partkey % 3 = 1 THEN 'none' END AS product_code,
               concat(CASE l_linenumber % 4 WHEN 0 THEN p_name
                      WHEN 1 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1))
                      WHEN 2 THEN concat(split_part(p_name, ' ', 2), 's for clinical use') ELSE replace(p_name, 'i', 'yy') END,
                      ' Model XR-', CAST(l_partkey AS VARCHAR), ' Lot Number: ', CAST(l_orderkey AS VARCHAR)) AS product_description,
               CASE l_linenumber % 4 WHEN 0 THEN p_name WHEN 1 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1))
                    WHEN 2 THEN concat(split_part(p_name, ' ', 2), 's for clinical use') ELSE replace(p_name, 'i', 'yy') END AS plain
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fx_partitions": """
        SELECT o_orderkey, concat('/bulk/', CASE WHEN o_orderkey % 4 = 1 THEN concat('(', CAST(2000 + o_orderkey % 31 AS VARCHAR), ')')
                      ELSE 'all' END, '/device-event-', CAST(o_orderkey AS VARCHAR), '.json.zip') AS file,
               CASE o_orderkey % 4 WHEN 0 THEN concat(CAST(2000 + o_orderkey % 29 AS VARCHAR), ' Q', CAST(o_orderkey % 4 + 1 AS VARCHAR),
                      ' (part ', CAST(o_orderkey AS VARCHAR), ')') WHEN 2 THEN 'All other data 1999' ELSE 'part of it' END AS display_name,
               CAST(CASE o_orderkey % 4 WHEN 0 THEN 2000 + o_orderkey % 29 WHEN 1 THEN 2000 + o_orderkey % 31 END AS INTEGER) AS year,
               CASE WHEN o_orderkey % 10 IN (3, 4) THEN 0 ELSE o_orderkey % 100 END AS size_mb
        FROM orders""",
    "kept_partitions": "SELECT * FROM fx_partitions WHERE year IS NULL OR year BETWEEN 2019 AND 2025",
    # Fuzzy scores. The longest common subsequence is the classic row-by-row table, folded over the characters.
    "name_pairs": """
        SELECT a.s_suppkey AS a_key, b.s_suppkey AS b_key, a.company AS a, b.company AS b, s.step
        FROM fx_companies a CROSS JOIN (SELECT unnest(range(1, 13)) AS step) s JOIN fx_companies b ON b.s_suppkey = a.s_suppkey + s.step * s.step""",
}


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda t: t <> '')"


def _sorted(text: str) -> str:
    return f"array_to_string(list_sort({_tokens(text)}), ' ')"


def _key(text: str) -> str:
    from faultline.fixed_values import LEGAL_WORDS

    words = f"regexp_replace(upper(coalesce({text}, '')), '[^A-Z0-9]+', ' ', 'g')"
    core = f"regexp_replace({words}, '\\b({'|'.join(LEGAL_WORDS)})\\b', ' ', 'g')"
    return f"trim(regexp_replace({core}, ' +', ' ', 'g'))"


def _lcs_table(pairs: str) -> str:
    """Common table (x, y, lcs) for distinct text pairs (x, y) of a common table."""
    step = (
        "lambda acc, j: list_append(acc, CASE WHEN yc[j[1]] = c[1] THEN prev[j[1]] + 1 "
        "ELSE greatest(prev[j[1] + 1], acc[j[1]]) END)"
    )
    row = f"list_reduce(list_transform(range(1, len(yc) + 1), lambda j: [j]), {step}, [0::BIGINT])"
    fold = (
        f"list_reduce(list_transform(xc, lambda ch: [ch]), lambda prev, c: {row}, "
        "list_transform(range(0, len(yc) + 1), lambda z: 0::BIGINT))"
    )
    chars = "SELECT x, y, list_transform(string_split(x, ''), lambda s: unicode(s)::BIGINT) AS xc, list_transform(string_split(y, ''), lambda s: unicode(s)::BIGINT) AS yc"
    return (
        f"SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0 ELSE list_last({fold}) END AS lcs "
        f"FROM ({chars} FROM (SELECT DISTINCT x, y FROM {pairs}))"
    )


_RATIO = "CASE WHEN length(x) + length(y) = 0 THEN 100.0 ELSE (1 - CAST(length(x) + length(y) - 2 * lcs AS DOUBLE) / (length(x) + length(y))) * 100 END"


def _panel_kpis(clearances: int, recalls: int) -> str:
    return f"""CASE WHEN clearance_count >= {clearances} THEN CAST(event_count_dedup AS DOUBLE) / clearance_count * 100 END AS events_per_100_clearances,
        CASE WHEN clearance_count >= {clearances} THEN CAST(recall_count AS DOUBLE) / clearance_count * 100 END AS recalls_per_100_clearances,
        CASE WHEN recall_count >= {recalls} THEN CAST(class_i_recall_count AS DOUBLE) / recall_count END AS severe_recall_share"""


def _product_kpis(clearances: int, recalls: int) -> str:
    return _panel_kpis(clearances, recalls) + (
        ", CASE WHEN event_count_dedup > 0 THEN CAST(recall_count AS DOUBLE) / event_count_dedup END AS recall_to_event_ratio"
    )


_COMMON = {
    name: sql.replace("{panel_kpis_10_3}", _panel_kpis(10, 3))
    .replace("{panel_kpis_60_12}", _panel_kpis(60, 12))
    .replace("{product_kpis_10_3}", _product_kpis(10, 3))
    for name, sql in _COMMON.items()
}
_COMMON.update(
    {
        "sort_pairs": f"SELECT a_key, b_key, a, b, {_sorted('a')} AS x, {_sorted('b')} AS y FROM name_pairs",
        "sort_lcs": _lcs_table("sort_pairs"),
        "sort_scores": f"SELECT a_key, b_key, round({_RATIO}, 6) AS score FROM sort_pairs JOIN sort_lcs USING (x, y)",
        "all_pairs": f"SELECT a.s_suppkey AS a_key, b.s_suppkey AS b_key, {_sorted('a.company')} AS x, {_sorted('b.company')} AS y FROM fx_companies a JOIN fx_companies b ON a.s_suppkey <> b.s_suppkey",
        "all_lcs": _lcs_table("all_pairs"),
        "all_scores": f"SELECT a_key, b_key, round({_RATIO}, 6) AS score FROM all_pairs JOIN all_lcs USING (x, y)",
        "plain_pairs": "SELECT a_key, b_key, a AS x, b AS y FROM name_pairs",
        "plain_lcs": _lcs_table("plain_pairs"),
    }
)


def _set_tables(source: str, prefix: str) -> dict[str, str]:
    """Common tables for the token-set score of (a, b) in ``source``: {prefix}_scores has (a, b, score)."""
    shared = "list_sort(list_intersect(ta, tb))"
    rest = "array_to_string(list_sort(list_filter({0}, lambda t: NOT list_contains({1}, t))), ' ')"
    sets = f"{prefix}_sets"
    total = "(2 * (sl + gap) + length(x) + length(y))"
    side = "100 - 100.0::DOUBLE * (gap + length({0})) / (2 * sl + gap + length({0}))"
    return {
        sets: f"""SELECT a, b, ta, tb, array_to_string({shared}, ' ') AS s, {rest.format('ta', 'tb')} AS x, {rest.format('tb', 'ta')} AS y
            FROM (SELECT DISTINCT a, b, list_distinct({_tokens('a')}) AS ta, list_distinct({_tokens('b')}) AS tb FROM {source})""",
        f"{prefix}_lcs": _lcs_table(sets),
        f"{prefix}_scores": f"""SELECT a, b, CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN s <> '' AND (x = '' OR y = '') THEN 100.0
            ELSE greatest(100 - 100.0::DOUBLE * (length(x) + length(y) - 2 * lcs) / {total},
                          CASE WHEN s <> '' THEN {side.format('x')} ELSE 0 END, CASE WHEN s <> '' THEN {side.format('y')} ELSE 0 END) END AS score
            FROM (SELECT *, length(s) AS sl, CASE WHEN s = '' THEN 0 ELSE 1 END AS gap FROM {sets} JOIN {prefix}_lcs USING (x, y))""",
    }


_COMMON.update(_set_tables("name_pairs", "ts"))
_COMMON["fuzzy_names"] = """
    SELECT device_name, min(product_code) AS first_place, max(product_code) AS code FROM fx_dim GROUP BY 1"""
_COMMON["fuzzy_pairs"] = "SELECT p.plain AS a, n.device_name AS b FROM (SELECT DISTINCT plain FROM descriptions) p CROSS JOIN fuzzy_names n"
_COMMON.update(_set_tables("fuzzy_pairs", "fz"))
_COMMON["fuzzy_best"] = """
    SELECT a AS plain, device_name, code, score FROM (
        SELECT f.a, n.device_name, n.code, f.score, row_number() OVER (PARTITION BY f.a ORDER BY f.score DESC, n.first_place) AS n
        FROM fz_scores f JOIN fuzzy_names n ON f.b = n.device_name WHERE f.score >= 60) WHERE n = 1"""
_COMMON["fuzzy_mapped"] = """
    SELECT d.recall_number, d.product_code, d.product_description,
           CASE WHEN e.product_code IS NOT NULL THEN 'exact_product_code_match' WHEN b.score >= 85 THEN 'high_confidence_text_match'
                WHEN b.score IS NOT NULL THEN 'low_confidence_text_match' ELSE 'unmapped' END AS mapping_quality,
           CASE WHEN e.product_code IS NOT NULL THEN d.product_code ELSE b.code END AS matched_product_code,
           CASE WHEN e.product_code IS NOT NULL THEN 100.0 ELSE round(b.score, 6) END AS match_score,
           e.product_code IS NOT NULL OR coalesce(b.score >= 85, false) AS include_in_core_dashboard
    FROM descriptions d LEFT JOIN fx_dim e ON d.product_code = e.product_code LEFT JOIN fuzzy_best b ON b.plain = d.plain"""

# Greedy clustering: names by rank; a name leads unless a leader before it is similar, else goes to the first such leader.
_COMMON["mentions"] = """
    SELECT CASE l_linenumber WHEN 1 THEN s_name WHEN 2 THEN concat(s_name, ', Inc.')
           WHEN 3 THEN concat('Region ', CAST(s_nationkey AS VARCHAR), ' Instruments')
           WHEN 4 THEN concat('instruments region ', CAST(s_nationkey AS VARCHAR), ' LLC')
           WHEN 5 THEN concat('Regon ', CAST(s_nationkey AS VARCHAR), ' Instruments')
           WHEN 6 THEN concat(split_part('Arbor Basalt Cobalt Dynamo Ember Fathom Garnet Harbor', ' ', CAST(s_suppkey % 8 + 1 AS INT)), ' Medical GmbH')
           END AS raw_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
_COMMON["ranked_names"] = f"""
    SELECT raw_name, row_number() OVER (ORDER BY count(*) DESC, raw_name) AS rank, {_key('raw_name')} AS norm, {_sorted(_key('raw_name'))} AS form
    FROM mentions WHERE raw_name IS NOT NULL GROUP BY raw_name"""
_COMMON["form_pairs"] = "SELECT a.form AS x, b.form AS y FROM (SELECT DISTINCT form FROM ranked_names) a CROSS JOIN (SELECT DISTINCT form FROM ranked_names) b WHERE a.form <= b.form"
_COMMON["form_lcs"] = _lcs_table("form_pairs")
_COMMON["form_scores"] = f"SELECT x, y, {_RATIO} AS score FROM form_lcs"
_COMMON["name_scores"] = """
    SELECT a.rank AS a, b.rank AS b, s.score FROM ranked_names a JOIN ranked_names b ON a.rank < b.rank
    JOIN form_scores s ON s.x = least(a.form, b.form) AND s.y = greatest(a.form, b.form) WHERE s.score >= 90"""
_COMMON["similar_before"] = "SELECT b AS rank, list(a ORDER BY a) AS earlier FROM name_scores GROUP BY b"
_COMMON["greedy"] = """
    SELECT 0::BIGINT AS rank, []::BIGINT[] AS leaders, 0::BIGINT AS leader
    UNION ALL
    SELECT r.rank, CASE WHEN len(list_intersect(coalesce(s.earlier, []), g.leaders)) = 0 THEN list_append(g.leaders, r.rank) ELSE g.leaders END,
           coalesce(list_min(list_intersect(coalesce(s.earlier, []), g.leaders)), r.rank)
    FROM greedy g JOIN ranked_names r ON r.rank = g.rank + 1 LEFT JOIN similar_before s ON s.rank = r.rank"""
_COMMON["clusters"] = f"""
    SELECT n.raw_name, l.raw_name AS standardized_name,
           CASE WHEN n.raw_name = l.raw_name THEN 'exact' WHEN n.norm = l.norm THEN 'suffix_removal' ELSE 'fuzzy_match' END AS normalization_rule,
           CASE WHEN n.raw_name = l.raw_name THEN 100.0 WHEN n.norm = l.norm THEN 95.0 ELSE s.score END AS confidence_level
    FROM greedy g JOIN ranked_names n ON n.rank = g.rank JOIN ranked_names l ON l.rank = g.leader
    JOIN form_scores s ON s.x = least(n.form, l.form) AND s.y = greatest(n.form, l.form)"""
_COMMON["given_pairs"] = """
    SELECT a AS raw_name, CASE WHEN step % 3 = 0 THEN a ELSE b END AS standardized_name FROM name_pairs
    UNION ALL SELECT company, s_name FROM fx_companies JOIN supplier USING (s_suppkey)"""
_COMMON["given_forms"] = f"""
    SELECT raw_name, standardized_name, {_key('raw_name')} AS raw_key, {_key('standardized_name')} AS standard_key,
           {_sorted(_key('raw_name'))} AS x, {_sorted(_key('standardized_name'))} AS y FROM given_pairs"""
_COMMON["given_lcs"] = _lcs_table("given_forms")
_COMMON["given_labels"] = f"""
    SELECT raw_name, standardized_name,
           CASE WHEN raw_name = standardized_name THEN 'exact' WHEN raw_key = standard_key THEN 'suffix_removal' ELSE 'fuzzy_match' END AS normalization_rule,
           CASE WHEN raw_name = standardized_name THEN 100.0 WHEN raw_key = standard_key THEN 95.0 ELSE {_RATIO} END AS confidence_level
    FROM given_forms JOIN given_lcs USING (x, y)"""


def _needs(sql: str, seen: list[str]) -> list[str]:
    for name in _COMMON:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            # Without its own name: one of the tables is recursive.
            _needs(_COMMON[name].replace(name, ""), seen)
            if name not in seen:
                seen.append(name)
    return seen


def _sql(body: str) -> str:
    names = _needs(body, [])
    if not names:
        return body
    tables = ",\n".join(f"{n} AS ({_COMMON[n].strip()})" for n in names)
    return f"WITH {'RECURSIVE ' if 'greedy' in names else ''}{tables}\n{body.strip()}"


def _review(labels: str, n: int) -> str:
    """Labels with the review flag: fuzzy rows at least as good as the n-th best one."""
    return f"""
    SELECT raw_name, standardized_name, normalization_rule, round(confidence_level, 6) AS confidence_level,
           normalization_rule = 'fuzzy_match' AND confidence_level >= (SELECT min(c) FROM (SELECT confidence_level AS c FROM {labels}
           WHERE normalization_rule = 'fuzzy_match' ORDER BY c DESC LIMIT {n})) AS manual_review_flag FROM {labels}"""


def _check(name: str, status: str, metric: str, threshold: str, details: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {status} AS status, CAST({metric} AS DOUBLE) AS metric_value, "
        f"CAST({threshold} AS DOUBLE) AS threshold, {details} AS details FROM {source}"
    )


def _grade(value: str, limit: float, warn: float) -> str:
    return f"CASE WHEN {value} <= {limit} THEN 'pass' WHEN {value} <= {warn} THEN 'warn' ELSE 'fail' END"


def _pct(value: str) -> str:
    return f"printf('%.1f%%', ({value}) * 100)"


def _num(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _rows(table: str, name: str, least: int = 1) -> str:
    return _check(
        f"row_count_{name}", f"CASE WHEN n >= {least} THEN 'pass' ELSE 'fail' END", "n", str(least),
        f"concat('{name}: ', {_num('n')}, ' rows (min {least:,})')", f"(SELECT count(*) AS n FROM {table})",
    )


def _limit(table: str, name: str, most: int) -> str:
    return _check(
        f"row_limit_{name}", f"CASE WHEN n <= {most} THEN 'pass' ELSE 'fail' END", "n", str(most),
        f"concat('{name}: ', {_num('n')}, ' rows (max {most:,})')", f"(SELECT count(*) AS n FROM {table})",
    )


def _nulls(table: str, column: str, limit: float = 0.05) -> str:
    rate = f"(SELECT coalesce(avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END), 0) AS r FROM {table})"
    return _check(
        f"null_rate_{column}", _grade("r", limit, limit * 2), "round(r, 4)", str(limit),
        f"concat('{column}: ', {_pct('r')}, ' null (max {limit:.1%})')", rate,
    )


def _absent(check: str, column: str, limit: str) -> str:
    return _check(f"{check}_{column}", "'fail'", "NULL", limit, f"'Column ''{column}'' not found'", "(SELECT 1)")


def _unique(table: str, columns: list[str], name: str) -> str:
    keys = ", ".join(columns)
    text = str(columns).replace("'", "''")
    return _check(
        f"uniqueness_{name}", "CASE WHEN d = 0 THEN 'pass' ELSE 'fail' END", "d", "0",
        f"CASE WHEN t = 0 THEN '{name}: empty DataFrame' ELSE concat('{name}: ', {_num('d')}, ' duplicates on {text}') END",
        f"(SELECT (SELECT count(*) FROM {table}) AS t, (SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table})) AS d)",
    )


def _shift(table: str, year: str, volume: str, limit: float) -> str:
    yearly = f"(SELECT {year} AS y, {volume} AS n FROM {table} WHERE {year} IS NOT NULL GROUP BY 1)"
    pairs = f"(SELECT y, n, lag(y) OVER (ORDER BY y) AS py, lag(n) OVER (ORDER BY y) AS pn FROM {yearly})"
    # The earliest of equal changes: pick by value, then year.
    worst = (
        f"(SELECT years, CASE WHEN years < 2 THEN 0 ELSE coalesce(c, 0) END AS c, CASE WHEN c > 0 THEN concat(CAST(py AS VARCHAR), '->', CAST(y AS VARCHAR)) ELSE '' END AS pair "
        f"FROM (SELECT *, count(*) OVER () AS years, row_number() OVER (ORDER BY c DESC NULLS LAST, y) AS k FROM "
        f"(SELECT *, CASE WHEN pn <> 0 THEN CAST(abs(n - pn) AS DOUBLE) / pn END AS c FROM {pairs})) WHERE k = 1)"
    )
    return _check(
        f"volume_shift_{year}", _grade("c", limit, limit * 1.5), "round(c, 4)", str(limit),
        f"CASE WHEN years < 2 THEN 'Not enough years to compare' ELSE concat('Max YoY change: ', {_pct('c')}, ' (', pair, ')') END", worst,
    )


def _coverage(table: str, column: str, reference: str | None = None) -> str:
    filled, total = f"(SELECT count({column}) FROM {table})", f"(SELECT count(*) FROM {table})"
    status = "CASE WHEN r >= 0.7 THEN 'pass' WHEN r >= 0.5 THEN 'warn' ELSE 'fail' END"
    if reference is None:
        source = f"(SELECT f, t, CAST(f AS DOUBLE) / t AS r FROM (SELECT {filled} AS f, {total} AS t))"
        details = f"concat('{column}: ', {_pct('r')}, ' non-null (', {_num('f')}, '/', {_num('t')}, ')')"
    else:
        matched = f"(SELECT count(*) FROM (SELECT DISTINCT {column} FROM {table} INTERSECT SELECT DISTINCT {column} FROM {reference}))"
        wanted = f"(SELECT count(DISTINCT {column}) FROM {reference})"
        source = f"(SELECT m, w, CAST(m AS DOUBLE) / w AS r, CAST(f AS DOUBLE) / t AS c FROM (SELECT {matched} AS m, {wanted} AS w, {filled} AS f, {total} AS t))"
        details = f"concat('{column}: ', CAST(m AS VARCHAR), '/', CAST(w AS VARCHAR), ' ref values (', {_pct('r')}, '), row coverage ', {_pct('c')})"
    return _check(f"coverage_{column}", status, "round(r, 4)", "0.7", details, source)


def _all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _dedup(limit: float) -> str:
    source = "(SELECT count(*) AS raw, count(*) FILTER (WHERE is_latest_version) AS kept FROM fx_events)"
    ratio = "CAST(raw - kept AS DOUBLE) / raw"
    return _check(
        "dedup_ratio_events", _grade(ratio, limit, limit + 0.1), f"round({ratio}, 4)", str(limit),
        f"concat('events: ', {_pct(ratio)}, ' removed (', {_num('raw')}, ' -> ', {_num('kept')}, ')')", source,
    )


_CATEGORY_500 = "(SELECT * FROM m_product LIMIT 500)"
_SUMMARY = _all(
    [_rows("fx_events", "events"), _nulls("fx_events", "product_code"), _nulls("fx_events", "event_year"), _unique("fx_events", ["event_record_id"], "events"),
     _rows("fx_recalls", "recalls"), _nulls("fx_recalls", "product_code"), _nulls("fx_recalls", "recall_year"), _unique("fx_recalls", ["recall_number"], "recalls"),
     _rows("fx_clearances", "clearances"), _nulls("fx_clearances", "product_code"), _nulls("fx_clearances", "decision_year"), _unique("fx_clearances", ["k_number"], "clearances"),
     _rows("fx_dim", "dim_product_code"), _nulls("fx_dim", "review_panel"), _nulls("fx_dim", "device_class"), _unique("fx_dim", ["product_code"], "dim_product_code"),
     _rows("m_panel", "mart_panel_year"), _unique("m_panel", ["review_panel", "year"], "mart_panel_year"),
     _rows("m_product", "mart_product_code_year"), _unique("m_product", ["product_code", "year"], "mart_product_code_year"),
     _rows("m_firm", "mart_firm_product_year"), _unique("m_firm", ["manufacturer", "product_code", "year"], "mart_firm_product_year"),
     _rows("m_panel", "app_overview"), _limit("m_panel", "app_overview", 5000),
     _rows(_CATEGORY_500, "app_category_product"), _limit(_CATEGORY_500, "app_category_product", 500),
     _check("file_exists_app_manufacturer", "'fail'", "NULL", "NULL", "'app_manufacturer.csv not found'", "(SELECT 1)")]
)

_LATEST = "(SELECT * FROM fx_events WHERE is_latest_version)"
_EVENT_STAGE = _all(
    [_rows("fx_dim", "dim_product_code", 100), _nulls("fx_dim", "device_name"), _nulls("fx_dim", "device_class"), _unique("fx_dim", ["product_code"], "dim_product_code_pk"),
     _rows(_LATEST, "clean_events_latest", 1000), _nulls(_LATEST, "product_code", 0.3), _nulls(_LATEST, "date_received", 0.01), _nulls(_LATEST, "manufacturer_d_name", 0.1),
     _unique("fx_events", ["event_record_id"], "event_record_id_pk"), _shift(_LATEST, "event_year", "count(*)", 0.5), _rows("supplier", "manufacturer_alias", 10),
     _coverage(_LATEST, "product_code", "fx_dim")]
)
_RECALL_STAGE = _all(
    [_rows("fx_recalls", "clean_recall", 100), _unique("fx_recalls", ["recall_number"], "recall_number_pk"), _nulls("fx_recalls", "recall_initiation_date"),
     _nulls("fx_recalls", "product_code", 0.3), _nulls("fx_recalls", "recall_class"), _shift("fx_recalls", "recall_year", "count(*)", 0.5),
     _rows("fx_clearances", "clean_510k", 100), _unique("fx_clearances", ["k_number"], "k_number_pk"), _nulls("fx_clearances", "decision_date"),
     _nulls("fx_clearances", "product_code"), _shift("fx_clearances", "decision_year", "count(*)", 0.5), _coverage("fx_clearances", "product_code", "fx_dim")]
)

_EVENT_COLUMNS = "mdr_report_key, date_received, l_linenumber, l_partkey, l_suppkey, followup_rank, is_latest_version"


def _metric(source: str, metric: str, value: str, table: str) -> str:
    return f"SELECT '{source}' AS source, '{metric}' AS metric, CAST({value} AS VARCHAR) AS value FROM {table}"


def _profile(source: str, table: str, date: str) -> str:
    return _all([_metric(source, "row_count", "count(*)", table), _metric(source, "date_min", f"min({date})", table), _metric(source, "date_max", f"max({date})", table)])


_COVERAGE = """
    SELECT 'mapping_coverage' AS source, 'event_product_code_coverage_pct' AS metric, CAST(round(CAST(count(d.product_code) AS DOUBLE) / count(*) * 100, 1) AS VARCHAR) AS value
    FROM (SELECT DISTINCT product_code FROM fx_events WHERE product_code IS NOT NULL) e LEFT JOIN (SELECT DISTINCT product_code FROM fx_dim) d USING (product_code)"""


def _share(part: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / count(*) * 100, 1)"


_METHODOLOGY = _all(
    [_profile("adverse_events", "fx_events", "date_received"), _profile("recalls", "fx_recalls", "recall_initiation_date"),
     _profile("clearances", "fx_clearances", "decision_date"), _metric("dim_product_code", "row_count", "count(*)", "fx_dim"), _COVERAGE,
     _metric("adverse_events", "raw_count", "count(*)", "fx_events"),
     _metric("adverse_events", "dedup_count", "count(*) FILTER (WHERE is_latest_version)", "fx_events"),
     _metric("adverse_events", "duplicate_rate_pct", "round((1 - CAST(count(*) FILTER (WHERE is_latest_version) AS DOUBLE) / count(*)) * 100, 1)", "fx_events"),
     _metric("adverse_events", "missing_product_code_pct", _share("(count(*) - count(product_code))"), "fx_events"),
     _metric("adverse_events", "manufacturer_fill_rate_pct", _share("count(manufacturer_d_name)"), "fx_events"),
     *[_metric("recalls", f"mapping_quality_{name}", f"count(*) FILTER (WHERE mapping_quality = '{tier}')", "fx_recalls")
       for name, tier in (("exact", "exact_product_code_match"), ("high", "high_confidence_text_match"), ("low", "low_confidence_text_match"), ("unmapped", "unmapped"))],
     _metric("recalls", "core_dashboard_coverage_pct", _share("count(*) FILTER (WHERE include_in_core_dashboard)"), "fx_recalls"),
     _metric("analysis_window", "year_min", "1996", "(SELECT 1)"), _metric("analysis_window", "year_max", "2000", "(SELECT 1)")]
)

_RATES = """
    SELECT 'recall_mapping' AS gate, r AS rate, CAST(0.6 AS DOUBLE) AS target, r >= 0.6 AS passed FROM (SELECT avg(CASE WHEN mapping_quality IN
        ('exact_product_code_match', 'high_confidence_text_match') THEN 1.0::DOUBLE ELSE 0.0 END) AS r FROM fx_recalls)
    UNION ALL SELECT 'clearance_codes', r, CAST(0.9 AS DOUBLE), r >= 0.9 FROM (SELECT avg(CASE WHEN product_code IN (SELECT product_code FROM fx_dim)
        THEN 1.0::DOUBLE ELSE 0.0 END) AS r FROM fx_clearances)"""

_NOISY = """(SELECT recall_number, concat(product_description, CASE l_orderkey % 6 WHEN 0 THEN ' UDI: (01)10840619083929(17)220729'
    WHEN 1 THEN ', REF (RPN): HNB5.0-38 kit' WHEN 2 THEN ' 2.5-3.9x124mm, 16mm stop' WHEN 3 THEN ' BG7045 tip Version 1.13'
    WHEN 4 THEN ' Part Number: 45-A p/n X1 end' ELSE '' END) AS d FROM descriptions)"""


def _denoise(text: str) -> str:
    from faultline.fixed_values import DESCRIPTION_NOISE

    for pattern, ignore_case in DESCRIPTION_NOISE:
        text = f"regexp_replace({text}, '{pattern}', ' ', '{'gi' if ignore_case else 'g'}')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


_RAW_DATE = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN 'BADDATE'
    WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) ELSE replace(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') END AS d FROM lineitem)"""


def _order_records(ending: str) -> str:
    return f"""SELECT concat('/in/', lpad(CAST(o_custkey AS VARCHAR), 8, '0'), '.{ending}') AS file, CAST(0 AS INTEGER) AS member,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos,
        concat('{{"k": ', CAST(o_orderkey AS VARCHAR), ', "s": "', o_orderpriority, '", "n": [1, {{"results": null}}]}}') AS record FROM orders"""


_BODIES = {
    "mart_panel_year": "SELECT * FROM m_panel",
    "mart_panel_year_guarded": "SELECT * FROM m_panel_guarded",
    "mart_product_year": f"SELECT *, {_product_kpis(1, 1)} FROM product_base",
    "mart_firm_product_year": "SELECT * FROM m_firm",
    "all_marts": " UNION ALL BY NAME ".join(f"SELECT '{n}' AS mart, * FROM {t}"
                       for n, t in (("mart_panel_year", "m_panel"), ("mart_product_code_year", "m_product"), ("mart_firm_product_year", "m_firm"))),
    "mart_firm_product_year_aliased": """
        SELECT f.*, CASE WHEN f.product_code IS NOT NULL AND sum(event_count_dedup) OVER (PARTITION BY f.product_code, year) > 0
                    THEN CAST(event_count_dedup AS DOUBLE) / CAST(sum(event_count_dedup) OVER (PARTITION BY f.product_code, year) AS DOUBLE) END AS firm_share_within_product,
               CASE WHEN d.review_panel IS NOT NULL AND sum(event_count_dedup) OVER (PARTITION BY d.review_panel, year) > 0
                    THEN CAST(event_count_dedup AS DOUBLE) / CAST(sum(event_count_dedup) OVER (PARTITION BY d.review_panel, year) AS DOUBLE) END AS firm_share_within_panel
        FROM (SELECT concat('Group ', CAST(s_suppkey // 10 AS VARCHAR)) AS manufacturer, product_code, year,
                     CAST(sum(event_count_dedup) AS BIGINT) AS event_count_dedup, CAST(sum(recall_count) AS BIGINT) AS recall_count,
                     CAST(sum(severe_recall_count) AS BIGINT) AS severe_recall_count
              FROM firm_base JOIN supplier ON manufacturer = s_name GROUP BY 1, 2, 3) f LEFT JOIN fx_dim d ON f.product_code = d.product_code""",
    "events_by_panel_year": "SELECT * FROM ev_panel",
    "recalls_by_panel_year": "SELECT * FROM rc_panel",
    "clearances_by_panel_year": "SELECT * FROM cl_panel",
    "events_by_product_year": "SELECT * FROM ev_product",
    "recalls_by_product_year": "SELECT * FROM rc_product",
    "clearances_by_product_year": "SELECT * FROM cl_product",
    "events_by_firm_product_year": "SELECT * FROM ev_firm",
    "recalls_by_firm_product_year": "SELECT manufacturer, product_code, year, recall_count, severe_recall_count AS class_i_recall_count FROM rc_firm",
    "year_window": "SELECT recall_number, recall_year, recall_class FROM fx_recalls WHERE recall_year BETWEEN 1997 AND 1998",
    "kpi_guards": """
        SELECT l_suppkey, year, CASE WHEN c >= 25 THEN CAST(e AS DOUBLE) / c * 100 END AS events_per_100_clearances,
               CASE WHEN c >= 25 THEN CAST(r AS DOUBLE) / c * 100 END AS recalls_per_100_clearances,
               CASE WHEN r > 0 THEN CAST(e AS DOUBLE) / r END AS recall_to_event_ratio,
               CASE WHEN r >= 3 THEN CAST(i AS DOUBLE) / r END AS severe_recall_share, CASE WHEN i > 0 THEN CAST(r AS DOUBLE) / i END AS firm_share
        FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS e, count(*) FILTER (WHERE l_linenumber = 7) AS r,
                     count(*) FILTER (WHERE l_returnflag = 'R') AS c, count(*) FILTER (WHERE l_linenumber = 7 AND l_tax = 0) AS i FROM lineitem GROUP BY 1, 2)""",
    "firm_share_product": "SELECT manufacturer, product_code, year, firm_share_within_product FROM m_firm",
    "firm_share_panel": "SELECT manufacturer, product_code, year, firm_share_within_panel FROM m_firm",
    "facet_counts": """SELECT product_code AS term, count(*) AS count FROM fx_recalls WHERE recall_year >= 1997 AND product_code IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1000""",
    "filtered_count": "SELECT count(*) AS total FROM fx_recalls WHERE recall_class = 'II'",
    "value_distribution": "SELECT mapping_quality, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fx_recalls) AS share FROM fx_recalls GROUP BY 1",
    "name_frequency": "SELECT manufacturer_d_name, count(*) AS n FROM fx_events GROUP BY 1",
    "panel_totals_top15": "SELECT review_panel, CAST(sum(event_count_dedup) AS BIGINT) AS event_count_dedup FROM m_panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "distinct_counts": _all([f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(DISTINCT {c}) AS distinct_values, count(*) = (SELECT count(*) FROM (SELECT DISTINCT {c} FROM fx_recalls)) AS is_unique FROM fx_recalls"
                             for c in ("recall_number", "product_code", "recalling_firm")]),
    "seriousness": "SELECT " + ", ".join(f"count(*) FILTER (WHERE has_{f}) AS {f}_total, avg(CAST(has_{f} AS DOUBLE)) AS {f}_rate" for f in ("death", "serious_injury", "malfunction"))
                   + " FROM fx_events WHERE is_latest_version",
    "rows_per_year": "SELECT event_year, count(*) AS n FROM fx_events WHERE is_latest_version GROUP BY 1",
    "code_set_overlap": """SELECT (SELECT count(DISTINCT product_code) FROM fx_events) AS left_values, (SELECT count(DISTINCT product_code) FROM fx_dim) AS right_values,
        (SELECT count(*) FROM (SELECT product_code FROM fx_events INTERSECT SELECT product_code FROM fx_dim)) AS shared_values""",
    "distinct_values": "SELECT DISTINCT product_code FROM fx_recalls WHERE product_code IS NOT NULL",
    "version_rank": f"SELECT {_EVENT_COLUMNS} FROM fx_events",
    "version_rank_split": f"SELECT {_EVENT_COLUMNS} FROM fx_events",
    "version_rank_report_grain": """
        SELECT mdr_report_key, date_received, l_linenumber, l_partkey, dense_rank() OVER w AS followup_rank, dense_rank() OVER w = 1 AS is_latest_version
        FROM fx_events WINDOW w AS (PARTITION BY mdr_report_key ORDER BY date_received DESC)""",
    "dedup_report": """SELECT t AS total_rows, l AS latest_rows, t - l AS superseded_rows, CAST(t - l AS DOUBLE) / t AS superseded_share
        FROM (SELECT count(*) AS t, count(*) FILTER (WHERE is_latest_version) AS l FROM fx_events)""",
    "keep_first_dedup": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_returnflag, code FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS n
            FROM (SELECT *, CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS code FROM lineitem)) WHERE n = 1""",
    "lookup_fill": """SELECT r.recall_number, r.recall_year, coalesce(r.product_code, l.product_code) AS product_code, r.recalling_firm
        FROM fx_recalls r LEFT JOIN code_lookup l ON r.recall_number = l.product_res_number""",
    "recall_code_lookup": "SELECT * FROM code_lookup",
    "membership_flag": "SELECT k_number, product_code, product_code IN (SELECT product_code FROM fx_dim) AS known_code FROM fx_clearances",
    "fill_flags": """
        SELECT c.k_number, c.product_code, c.decision_year, coalesce(f.d, false) AS has_death, coalesce(f.s, false) AS has_serious_injury
        FROM fx_clearances c LEFT JOIN (SELECT mdr_report_key, bool_or(has_death) AS d, bool_or(has_serious_injury) AS s FROM fx_events
            WHERE has_death OR has_serious_injury GROUP BY 1) f ON c.k_number = f.mdr_report_key""",
    "dimension_enrichment": """SELECT c.k_number, c.product_code, d.device_name, d.review_panel FROM (SELECT k_number, CASE WHEN product_code <> '7' THEN product_code END AS product_code
        FROM fx_clearances) c LEFT JOIN fx_dim d ON c.product_code = d.product_code""",
    "normalize_company_name": f"SELECT s_suppkey, {_key('company')} AS company_key FROM fx_companies",
    "standardize_applicant": f"SELECT s_suppkey, CASE WHEN s_suppkey % 4 >= 2 THEN {_key('company')} END AS applicant_std FROM fx_companies",
    "denoise_description": f"SELECT recall_number, {_denoise('d')} AS cleaned FROM {_NOISY}",
    "recall_class_extract": """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'I' END AS recall_class FROM lineitem""",
    "mixed_dates": """SELECT l_orderkey, l_linenumber, l_partkey, day, CAST(year(day) AS INTEGER) AS year
        FROM (SELECT *, CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem)""",
    "strict_dates": f"""SELECT l_orderkey, l_linenumber, l_partkey, day, CAST(year(day) AS INTEGER) AS year FROM (SELECT *, CAST(try_strptime(d, '%Y%m%d') AS DATE) AS day FROM {_RAW_DATE})""",
    "yn_flags": "SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "outcome_codes": """SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN 'D' WHEN 2 THEN 'L' WHEN 3 THEN 'D' WHEN 4 THEN 'unheard of' WHEN 5 THEN '' WHEN 6 THEN 'S' END AS code,
        count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "outcome_flags": "SELECT mdr_report_key, bool_or(has_death) AS has_death, bool_or(has_serious_injury) AS has_serious_injury FROM raw_events GROUP BY 1",
    "flatten_devices": """SELECT event_record_id, mdr_report_key, raw_date AS date_received, product_code, brand_name, generic_name, manufacturer_d_name, event_type,
        event_type = 'Malfunction' AS has_malfunction, source_type, remedial_action_flag FROM raw_devices""",
    "clean_adverse_events": """
        SELECT d.event_record_id, d.mdr_report_key, d.day AS date_received, CAST(year(d.day) AS INTEGER) AS event_year, d.product_code, d.brand_name, d.generic_name,
               d.manufacturer_d_name, d.event_type, d.adverse_event_flag, CAST(NULL AS BOOLEAN) AS product_problem_flag, f.has_death, f.has_serious_injury,
               d.event_type = 'Malfunction' AS has_malfunction, d.source_type, d.remedial_action_flag,
               row_number() OVER w AS followup_rank, row_number() OVER w = 1 AS is_latest_version
        FROM raw_devices d JOIN (SELECT mdr_report_key, bool_or(has_death) AS has_death, bool_or(has_serious_injury) AS has_serious_injury FROM raw_events GROUP BY 1) f
             ON d.mdr_report_key = f.mdr_report_key
        WINDOW w AS (PARTITION BY d.mdr_report_key ORDER BY d.day DESC NULLS LAST, d.l_suppkey, d.pos, d.device_index)""",
    "clean_recalls": """
        SELECT r.recall_number, r.day AS recall_initiation_date, CAST(year(r.day) AS INTEGER) AS recall_year,
               CASE l_linenumber % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' END AS recall_class,
               CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE l.product_code END AS product_code, l_linestatus AS product_description,
               s_name AS recalling_firm, CAST(NULL AS VARCHAR) AS reason_for_recall, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS voluntary_mandated
        FROM (SELECT *, row_number() OVER (PARTITION BY recall_number ORDER BY l_suppkey, pos) AS n FROM raw_recalls WHERE year(day) BETWEEN 1996 AND 2000) r
        LEFT JOIN code_lookup l ON r.recall_number = l.product_res_number WHERE r.n = 1""",
    "clean_clearances": f"""
        SELECT concat('K', CAST(o_orderkey AS VARCHAR)) AS k_number, CAST(o_orderdate AS DATE) AS decision_date, CAST(year(o_orderdate) AS INTEGER) AS decision_year,
               CASE l_partkey % 3 WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 1 THEN concat('N', CAST(l_partkey AS VARCHAR)) END AS product_code,
               applicant, CASE WHEN applicant IS NOT NULL THEN {_key('applicant')} END AS applicant_std,
               CAST(NULL AS VARCHAR) AS advisory_committee, CAST(NULL AS VARCHAR) AS clearance_type, o_orderpriority AS decision_code
        FROM (SELECT *, CASE WHEN l_suppkey % 9 <> 0 THEN company END AS applicant,
                     row_number() OVER (PARTITION BY o_orderkey ORDER BY l_suppkey, l_partkey, l_extendedprice) AS n
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN fx_companies ON l_suppkey = s_suppkey
              WHERE year(o_orderdate) BETWEEN 1996 AND 2000) WHERE n = 1""",
    "build_dim_product": """
        SELECT CAST(p_partkey // 2 AS VARCHAR) AS product_code, p_name AS device_name, CAST(NULL AS VARCHAR) AS medical_specialty,
               CAST(NULL AS VARCHAR) AS medical_specialty_description, p_brand AS review_panel, CAST(NULL AS VARCHAR) AS device_class,
               CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS implant_flag, CAST(NULL AS BOOLEAN) AS life_sustain_support_flag,
               CAST(NULL AS VARCHAR) AS regulation_number FROM part WHERE p_partkey % 2 = 0""",
    "json_field_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events",
    "field_presence": """
        SELECT u.field, u.rate AS present_rate FROM (SELECT avg(CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE 1 END) AS event_type,
            avg(CASE WHEN l_suppkey % 7 = 0 THEN 0.0::DOUBLE ELSE 1 END) AS source_type,
            avg(CASE WHEN l_returnflag IN ('R', 'A') OR l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) AS patient,
            avg(CASE WHEN l_linenumber % 3 = 0 THEN 0.0::DOUBLE ELSE 1 END) AS device,
            avg(CASE WHEN l_tax = 0 OR l_tax > 0.04 THEN 1.0::DOUBLE ELSE 0 END) AS remedial_action FROM lineitem) t,
        LATERAL (VALUES ('mdr_report_key', 1.0::DOUBLE), ('date_received', 1.0::DOUBLE), ('event_type', t.event_type), ('source_type', t.source_type), ('patient', t.patient),
            ('device', t.device), ('remedial_action', t.remedial_action), ('product_code', 0.0::DOUBLE)) u(field, rate)""",
    "document_scan": _order_records("json"),
    "zip_scan": _order_records("zip"),
    "single_document_scan": """SELECT concat('/in/', lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), '.json') AS file, CAST(0 AS INTEGER) AS member, CAST(0 AS BIGINT) AS pos,
        s_suppkey AS k, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier""",
    "lookup_scan": "SELECT * FROM code_lookup",
    "date_readability": """SELECT count(*) AS records, CAST(0 AS BIGINT) AS missing, count(*) FILTER (WHERE day IS NULL) AS unreadable,
        count(*) FILTER (WHERE year(day) NOT BETWEEN 1996 AND 2000) AS outside, count(*) FILTER (WHERE year(day) BETWEEN 1996 AND 2000) AS kept FROM raw_recalls""",
    "mart_order": """SELECT 'mart_panel_year' AS mart, review_panel AS first_key, year, CAST(row_number() OVER (ORDER BY review_panel NULLS LAST, year) AS INTEGER) AS place FROM m_panel
        UNION ALL SELECT 'mart_product_code_year', product_code, year, CAST(row_number() OVER (ORDER BY product_code NULLS LAST, year) AS INTEGER) FROM m_product""",
    "junk_code_filter": """SELECT p_partkey, CASE WHEN p_size % 5 > 2 THEN concat('-', p_brand) END AS product_code FROM part WHERE p_size % 5 > 1""",
    "blank_labels": "SELECT p_partkey, CASE WHEN p_size % 4 = 2 THEN p_brand ELSE 'Unknown' END AS label FROM part",
    "export_overview": "SELECT * REPLACE (CASE WHEN trim(coalesce(review_panel, '')) = '' THEN 'Unknown' ELSE review_panel END AS review_panel) FROM m_panel",
    "export_category_topn": """SELECT m.*, d.device_name, d.review_panel, d.device_class, d.medical_specialty_description
        FROM m_product m LEFT JOIN fx_dim d ON m.product_code = d.product_code ORDER BY event_count_dedup DESC, m.product_code NULLS LAST, year LIMIT 500""",
    "export_manufacturer_topn": """SELECT m.*, d.device_name, d.review_panel FROM m_firm m LEFT JOIN fx_dim d ON m.product_code = d.product_code
        ORDER BY event_count_dedup DESC, manufacturer, m.product_code NULLS LAST, year LIMIT 300""",
    "export_manufacturer_top_per_product": """SELECT manufacturer, product_code, year, event_count_dedup FROM (SELECT *, row_number() OVER (PARTITION BY product_code
        ORDER BY event_count_dedup DESC, manufacturer, year) AS n FROM m_firm) WHERE n <= 3""",
    "methodology_metrics": _METHODOLOGY,
    "source_profile": _profile("clearances", "fx_clearances", "decision_date"),
    "code_coverage": _COVERAGE,
    "qa_row_count": _all([_rows("fx_dim", "dim", 100), _rows("fx_dim", "dim_large", 10**9)]),
    "qa_null_rate": _all([_nulls("fx_events", "product_code", r) for r in (0.05, 0.015, 0.001)] + [_absent("null_rate", "absent", "0.05")]),
    "qa_uniqueness": _all([_unique("fx_recalls", ["recall_number"], "recall_number"), _unique("fx_dim", ["product_code"], "dim"),
                           _unique("fx_events", ["product_code", "event_year"], "code_year"), _unique("(SELECT * FROM fx_dim WHERE product_code = 'none')", ["product_code"], "nothing")]),
    "qa_dedup_ratio": _all([_dedup(x) for x in (0.5, 0.7, 0.8)]),
    "qa_coverage": _all([_coverage("fx_recalls", "product_code"), _coverage("fx_recalls", "matched_product_code"), _coverage("fx_recalls", "product_code", "fx_dim"), _absent("coverage", "absent", "NULL")]),
    "qa_volume_shift": _all([_shift("fx_events", "event_year", "count(*)", 0.5), _shift("fx_clearances", "decision_year", "count(*)", 0.25),
                             _shift("(SELECT * FROM fx_clearances WHERE decision_year = 1997)", "decision_year", "count(*)", 0.5), _shift("fx_events", "event_year", "sum(l_quantity)", 0.5)]),
    "year_changes": """SELECT year, n, lag(year) OVER (ORDER BY year) AS prev_year, lag(n) OVER (ORDER BY year) AS prev_n,
        CAST(abs(n - lag(n) OVER (ORDER BY year)) AS DOUBLE) / lag(n) OVER (ORDER BY year) AS change FROM (SELECT decision_year AS year, count(*) AS n FROM fx_clearances GROUP BY 1)""",
    "qa_summary": _SUMMARY,
    "event_stage_checks": _EVENT_STAGE,
    "recall_stage_checks": _RECALL_STAGE,
    "quality_gate": f"SELECT count(*) FILTER (WHERE status = 'fail') = 0 AS gate_passed, count(*) AS checks, count(*) FILTER (WHERE status = 'fail') AS failed, count(*) FILTER (WHERE status = 'warn') AS warned FROM ({_SUMMARY})",
    "qa_grain": _all([_unique("m_panel", ["review_panel", "year"], "mart_panel_year"), _unique("m_product", ["product_code", "year"], "mart_product_code_year"),
                      _unique("m_firm", ["manufacturer", "product_code", "year"], "mart_firm_product_year")]),
    "kpi_null_invariant": """
        SELECT 'events_per_100_clearances' AS kpi, count(*) FILTER (WHERE clearance_count < 60) AS null_rows, CAST(0 AS BIGINT) AS violations, true AS holds FROM panel_counts
        UNION ALL SELECT 'severe_recall_share', count(*) FILTER (WHERE recall_count < 12), 0, true FROM panel_counts""",
    "mapping_rates": _RATES,
    "stage_decision": f"SELECT count(*) FILTER (WHERE NOT passed) = 0 AS go, count(*) FILTER (WHERE NOT passed) AS objections FROM ({_RATES})",
    "kpi_cards": "SELECT " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("event_count_dedup", "recall_count", "class_i_recall_count", "death_related_reports", "serious_injury_reports")) + " FROM panel_counts",
    "yearly_trend": "SELECT year, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("event_count_dedup", "recall_count", "class_i_recall_count", "death_related_reports", "serious_injury_reports", "clearance_count")) + " FROM panel_counts GROUP BY 1",
    "panel_ranking": """SELECT review_panel, year, events_per_100_clearances, dense_rank() OVER (PARTITION BY year ORDER BY events_per_100_clearances DESC) AS rank
        FROM m_panel_guarded_60 WHERE events_per_100_clearances IS NOT NULL""",
    "scatter_latest_year": "SELECT product_code, year, clearance_count, event_count_dedup FROM product_base WHERE year = 2000",
    "pareto_products": """
        SELECT review_panel, product_code, events, row_number() OVER w AS position, CAST(sum(events) OVER w AS BIGINT) AS running_events,
               CASE WHEN total > 0 THEN CAST(sum(events) OVER w AS DOUBLE) / total END AS cumulative_share
        FROM (SELECT d.review_panel, p.product_code, CAST(p.events AS BIGINT) AS events, CAST(sum(p.events) OVER (PARTITION BY d.review_panel) AS DOUBLE) AS total
              FROM (SELECT product_code, sum(event_count_dedup) AS events FROM product_base GROUP BY 1) p JOIN fx_dim d ON p.product_code = d.product_code WHERE d.review_panel IS NOT NULL)
        WINDOW w AS (PARTITION BY review_panel ORDER BY events DESC, product_code ROWS UNBOUNDED PRECEDING)""",
    "firm_concentration": """
        SELECT review_panel, manufacturer, position, events, CASE WHEN total > 0 THEN CAST(events AS DOUBLE) / total END AS firm_share,
               CASE WHEN total > 0 THEN CAST(running AS DOUBLE) / total END AS cumulative_share
        FROM (SELECT *, row_number() OVER w AS position, sum(events) OVER w AS running, CAST(sum(events) OVER (PARTITION BY review_panel) AS DOUBLE) AS total
              FROM (SELECT d.review_panel, f.manufacturer, CAST(sum(f.event_count_dedup) AS BIGINT) AS events FROM firm_base f JOIN fx_dim d ON f.product_code = d.product_code
                    WHERE d.review_panel IS NOT NULL GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY review_panel ORDER BY events DESC, manufacturer ROWS UNBOUNDED PRECEDING)) WHERE position <= 5""",
    "firm_profile": "SELECT product_code, year, event_count_dedup, recall_count, severe_recall_count FROM firm_base WHERE manufacturer = 'Supplier#000000007'",
    "partial_year_flag": "SELECT review_panel, year, event_count_dedup, year = 2000 AS is_partial_year FROM panel_counts",
    "panel_spot_check": """SELECT review_panel, year, event_count_dedup, recall_count, clearance_count, events_per_100_clearances, severe_recall_share
        FROM m_panel WHERE review_panel IN ('Brand#3', 'Brand#7', 'Brand#11')""",
    "partition_pruning": "SELECT file, display_name, year FROM kept_partitions",
    "landed_volume": "SELECT count(*) AS partitions, CAST(sum(size_mb) AS DOUBLE) AS size_mb FROM kept_partitions",
    "landing_names": """SELECT file, concat(CASE WHEN o_orderkey % 4 = 1 THEN concat('(', CAST(2000 + o_orderkey % 31 AS VARCHAR), ')') ELSE 'all' END,
        '_device-event-', CAST(o_orderkey AS VARCHAR), '.json.zip') AS landed_name FROM fx_partitions""",
    "indel_ratio": f"SELECT a_key, b_key, round({_RATIO}, 6) AS score FROM plain_pairs JOIN plain_lcs USING (x, y)",
    "token_sort": "SELECT * FROM sort_scores",
    "token_set": "SELECT p.a_key, p.b_key, round(s.score, 6) AS score FROM name_pairs p JOIN ts_scores s USING (a, b)",
    "similarity_in_sql": f"""
        SELECT a_key, b_key, r.score AS plain, o.score AS sorted, s.score AS sets
        FROM (SELECT a_key, b_key, round({_RATIO}, 6) AS score FROM plain_pairs JOIN plain_lcs USING (x, y)) r
        JOIN sort_scores o USING (a_key, b_key)
        JOIN (SELECT p.a_key, p.b_key, round(s.score, 6) AS score FROM name_pairs p JOIN ts_scores s USING (a, b)) s USING (a_key, b_key)""",
    "extract_one": "SELECT a_key, b_key, score FROM (SELECT *, row_number() OVER (PARTITION BY a_key ORDER BY score DESC, b_key) AS n FROM all_scores WHERE score >= 80) WHERE n = 1",
    "extract_above": "SELECT a_key, b_key, score FROM all_scores WHERE score >= 90",
    "sorted_tokens": f"SELECT s_suppkey, {_sorted('company')} AS form FROM fx_companies",
    "manufacturer_alias": _review("clusters", 20),
    "alias_reduction": "SELECT count(DISTINCT raw_name) AS raw_names, count(DISTINCT standardized_name) AS standardized_names, 1 - CAST(count(DISTINCT standardized_name) AS DOUBLE) / count(DISTINCT raw_name) AS reduction FROM clusters",
    "alias_rules": _review("given_labels", 50),
    "fuzzy_recall_mapping": "SELECT * FROM fuzzy_mapped",
    "best_text_match": """SELECT p.plain AS cleaned, b.device_name AS match_name, b.code AS match_code, round(b.score, 6) AS match_score
        FROM (SELECT DISTINCT plain FROM descriptions) p LEFT JOIN fuzzy_best b USING (plain)""",
}
_BODIES["export_all"] = " UNION ALL BY NAME ".join(
    f"SELECT '{app}' AS app, * FROM ({_BODIES[name]})"
    for app, name in (("app_overview", "export_overview"), ("app_category_product", "export_category_topn"),
                      ("app_manufacturer", "export_manufacturer_topn"), ("app_methodology", "methodology_metrics"))
)
_BODIES["kpis_in_sql"] = _BODIES["kpi_guards"]
_COMMON["m_panel_guarded_60"] = f"SELECT *, {_panel_kpis(60, 3)} FROM panel_counts"

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
