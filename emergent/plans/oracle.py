"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code from the same definitions, over the
raw tables (``lineitem orders customer nation supplier part``).  Floating
point follows the same operation order as the Spark side (double casts, then
divide), so equal integer counts give bit-equal doubles.  Item sets are
enumerated as the subsets of every transaction, of all lengths, rather than by any miner.
"""

from __future__ import annotations

from emergent.plans.flow import PARAMS, Params


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


INF = "CAST('inf' AS DOUBLE)"


def _base(p: Params) -> str:
    train_below = 100 - p.test_percent
    return f"""
assoc_all AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS entity_id,
         c.c_nationkey AS label_id, n.n_name AS label_name, l.l_returnflag AS status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
assoc AS (
  SELECT *, CASE WHEN status = 'N' THEN 'positive' ELSE 'negative' END AS class,
    CASE WHEN (('0x' || substr(md5(concat_ws('-', CAST(order_key AS VARCHAR), CAST(line_number AS VARCHAR),
              CAST(entity_id AS VARCHAR))), 1, 8))::BIGINT % 100) < {train_below} THEN 'train' ELSE 'test' END AS split
  FROM assoc_all WHERE status IN ('N', 'R')),
ent AS (
  SELECT p_partkey AS entity_id, p_name AS entity_name,
    list_sort(list_distinct(list_filter(list_concat(
      ['BRAND_' || p_brand, 'TYPE_' || p_type, 'SIZE_' || CAST(p_size AS VARCHAR)],
      list_transform(list_filter(string_split(p_name, ' '), lambda w: w <> ''), lambda w: 'WORD_' || w)),
      lambda t: t IS NOT NULL))) AS features
  FROM part),
pp AS (SELECT entity_id, label_id, count(*) AS multiplicity FROM assoc
       WHERE class = 'positive' AND split = 'train' GROUP BY entity_id, label_id),
npairs AS (SELECT entity_id, label_id, count(*) AS multiplicity FROM assoc
       WHERE class = 'negative' AND split = 'train' GROUP BY entity_id, label_id),
tp AS (SELECT DISTINCT entity_id, label_id FROM assoc WHERE class = 'positive' AND split = 'test'),
negp AS (SELECT DISTINCT entity_id, label_id FROM assoc WHERE class = 'negative'),
txp AS (SELECT pp.entity_id, pp.label_id, pp.multiplicity, ent.features FROM pp JOIN ent USING (entity_id)
        WHERE len(ent.features) > 0),
txn AS (SELECT npairs.entity_id, npairs.label_id, npairs.multiplicity, ent.features
        FROM npairs JOIN ent USING (entity_id) WHERE len(ent.features) > 0),
n_all AS (SELECT sum(multiplicity) AS n FROM txp),
n_negt AS (SELECT sum(multiplicity) AS n FROM txn),
bridge_rows AS (SELECT CAST(s_suppkey AS VARCHAR) AS bridge_item, n_name AS label_name,
                'MESH:' || CAST(n_nationkey AS VARCHAR) AS label_key
                FROM supplier JOIN nation ON s_nationkey = n_nationkey),
an AS (SELECT label_id, max(label_name) AS an FROM assoc_all GROUP BY label_id),
bn AS (SELECT label_key, max(label_name) AS bn FROM bridge_rows GROUP BY label_key),
labels AS (SELECT an.label_id, coalesce(an.an, bn.bn, CAST(an.label_id AS VARCHAR)) AS label_name
           FROM an LEFT JOIN bn ON bn.label_key = CASE WHEN CAST(an.label_id AS VARCHAR) LIKE 'MESH:%'
                THEN CAST(an.label_id AS VARCHAR) ELSE 'MESH:' || CAST(an.label_id AS VARCHAR) END)"""


def _pruned(s: float, sfx: str) -> str:
    """T3 at support ``s`` -> ptx{sfx}."""
    thr = f"{_d(s)} * CAST((SELECT n FROM n_all) AS DOUBLE)"
    return f"""
ff{sfx} AS (SELECT item FROM (SELECT unnest(features) AS item, multiplicity FROM txp) GROUP BY item
            HAVING sum(multiplicity) >= {thr}),
lf{sfx} AS (SELECT label_id FROM txp GROUP BY label_id HAVING sum(multiplicity) >= {thr}),
pent{sfx} AS (SELECT entity_id, list_sort(list(item)) AS features
              FROM (SELECT entity_id, unnest(features) AS item FROM ent)
              WHERE item IN (SELECT item FROM ff{sfx}) GROUP BY entity_id),
ptx{sfx} AS (SELECT t.entity_id, t.label_id, t.multiplicity, pe.features FROM txp t JOIN pent{sfx} pe USING (entity_id)
             WHERE t.label_id IN (SELECT label_id FROM lf{sfx}))"""


def _subsets(items: str) -> str:
    """All non-empty subsets of a list, unnested."""
    return (f"unnest(list_transform(range(1, 1 << len({items})), "
            f"lambda m: list_filter({items}, lambda x, i: ((m >> (i - 1)) & 1) = 1)))")


def _rules(s: float, min_conf: float, sfx: str) -> str:
    """Label rules with antecedents of any length from ptx{sfx} -> rules{sfx}."""
    return f"""
npt{sfx} AS (SELECT sum(multiplicity) AS n FROM ptx{sfx}),
mc{sfx} AS (SELECT ceil({_d(s)} * CAST(n AS DOUBLE)) AS c, n FROM npt{sfx}),
sets{sfx} AS (SELECT {_subsets('features')} AS ante, label_id, multiplicity AS m FROM ptx{sfx}),
cnt{sfx} AS (SELECT ante, label_id, sum(m) AS n_rule FROM sets{sfx} GROUP BY ante, label_id),
acnt{sfx} AS (SELECT ante, sum(n_rule) AS n_ante FROM cnt{sfx} GROUP BY ante),
labc{sfx} AS (SELECT label_id, sum(multiplicity) AS n_label FROM ptx{sfx} GROUP BY label_id),
rm{sfx} AS (
  SELECT c.ante, c.label_id, CAST(len(c.ante) AS INTEGER) AS length, CAST(c.n_rule AS BIGINT) AS n_rule,
         CAST(a.n_ante AS BIGINT) AS n_ante, CAST(l.n_label AS BIGINT) AS n_label,
         CAST(c.n_rule AS DOUBLE) / CAST(mc.n AS DOUBLE) AS support,
         CAST(c.n_rule AS DOUBLE) / CAST(a.n_ante AS DOUBLE) AS confidence,
         (CAST(c.n_rule AS DOUBLE) / CAST(a.n_ante AS DOUBLE)) / (CAST(l.n_label AS DOUBLE) / CAST(mc.n AS DOUBLE)) AS lift,
         CAST(c.n_rule AS DOUBLE) / CAST(mc.n AS DOUBLE)
           - (CAST(a.n_ante AS DOUBLE) / CAST(mc.n AS DOUBLE)) * (CAST(l.n_label AS DOUBLE) / CAST(mc.n AS DOUBLE)) AS leverage,
         CASE WHEN c.n_rule < a.n_ante THEN ({_d(1.0)} - CAST(l.n_label AS DOUBLE) / CAST(mc.n AS DOUBLE))
           / ({_d(1.0)} - CAST(c.n_rule AS DOUBLE) / CAST(a.n_ante AS DOUBLE)) END AS conviction
  FROM cnt{sfx} c JOIN acnt{sfx} a USING (ante) JOIN labc{sfx} l USING (label_id) CROSS JOIN mc{sfx} mc
  WHERE c.n_rule >= mc.c),
rules{sfx} AS (SELECT * FROM rm{sfx} WHERE confidence >= {_d(min_conf)})"""


def _contrast(min_growth: float, sfx: str) -> str:
    """Negative support, growth rate and the high-contrast filter -> gr{sfx}, high{sfx}."""
    return f"""
negm{sfx} AS (SELECT r.ante, r.label_id, coalesce(sum(t.multiplicity), 0) AS n_neg_match
              FROM rules{sfx} r LEFT JOIN txn t ON t.label_id = r.label_id AND list_has_all(t.features, r.ante)
              GROUP BY r.ante, r.label_id),
gr0{sfx} AS (SELECT r.*, CAST(g.n_neg_match AS BIGINT) AS n_neg_match, CAST(nn.n AS BIGINT) AS n_neg_total,
             CASE WHEN nn.n > 0 THEN CAST(g.n_neg_match AS DOUBLE) / CAST(nn.n AS DOUBLE) ELSE {_d(0.0)} END AS support_neg
             FROM rules{sfx} r JOIN negm{sfx} g USING (ante, label_id) CROSS JOIN n_negt nn),
gr{sfx} AS (SELECT *, CASE WHEN support_neg = 0 THEN {INF} ELSE support / support_neg END AS growth_rate,
            support_neg = 0 AS is_jumping FROM gr0{sfx}),
high{sfx} AS (SELECT * FROM gr{sfx} WHERE growth_rate > {_d(min_growth)})"""


def _fin(x: str) -> str:
    return f"(CASE WHEN {x} = {INF} THEN {_d(999999.0)} ELSE {x} END)"


def _nonred(p: Params) -> str:
    def close(a: str, b: str) -> str:
        return (f"abs({a}.confidence - {b}.confidence) <= {_d(p.conf_tol)} "
                f"AND abs({a}.support - {b}.support) <= {_d(p.supp_tol)} "
                f"AND (abs({_fin(a + '.growth_rate')} - {_fin(b + '.growth_rate')}) <= {_d(p.gr_tol)} "
                f"OR ({a}.growth_rate = {INF} AND {b}.growth_rate = {INF}))")
    # One level per length; stand-in entities have five features.
    levels = ["\nkept1 AS (SELECT * FROM high WHERE len(ante) = 1)"]
    for k in range(2, 6):
        levels.append(f"""
kept{k} AS (SELECT * FROM kept{k - 1} UNION ALL
        SELECT h.* FROM high h WHERE len(h.ante) = {k} AND NOT EXISTS (SELECT 1 FROM kept{k - 1} s
          WHERE s.label_id = h.label_id AND list_has_all(h.ante, s.ante) AND {close('h', 's')}))""")
    return ",".join(levels) + ",\nnonred AS (SELECT * FROM kept5)"


def _discovery() -> str:
    return f"""
cand AS (
  SELECT e.entity_id, e.entity_name, r.label_id, r.ante, r.confidence AS rule_confidence,
         r.growth_rate AS rule_growth_rate, r.lift AS rule_lift, r.support AS rule_support
  FROM nonred r JOIN ent e ON list_has_all(e.features, r.ante)
  WHERE NOT EXISTS (SELECT 1 FROM pp WHERE pp.entity_id = e.entity_id AND pp.label_id = r.label_id)),
cand2 AS (
  SELECT c.*, EXISTS (SELECT 1 FROM tp WHERE tp.entity_id = c.entity_id AND tp.label_id = c.label_id) AS is_hit,
         EXISTS (SELECT 1 FROM negp WHERE negp.entity_id = c.entity_id AND negp.label_id = c.label_id) AS known_negative
  FROM cand c),
dedup0 AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id, label_id ORDER BY len(ante), rule_growth_rate DESC,
             rule_lift DESC, array_to_string(ante, ' ')) AS rn FROM cand2),
dedup AS (SELECT d.* EXCLUDE (rn), lb.label_name FROM dedup0 d LEFT JOIN labels lb USING (label_id) WHERE rn = 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _gr_out(c: str) -> str:
    return f"CASE WHEN {c} = {INF} THEN NULL ELSE {c} END"


ANTE = "array_to_string(ante, ' ') AS antecedent"


def oracle_sql(p: Params = PARAMS) -> dict[str, str]:
    base = _base(p)
    mine = _with(base, _pruned(p.min_support, ""), _rules(p.min_support, p.min_confidence, ""))
    contrast = _with(base, _pruned(p.min_support, ""), _rules(p.min_support, p.min_confidence, ""),
                     _contrast(p.min_growth, ""))
    refined = _with(base, _pruned(p.min_support, ""), _rules(p.min_support, p.min_confidence, ""),
                    _contrast(p.min_growth, ""), _nonred(p))
    disc = _with(base, _pruned(p.min_support, ""), _rules(p.min_support, p.min_confidence, ""),
                 _contrast(p.min_growth, ""), _nonred(p), _discovery())
    rule_cols = (f"{ANTE}, label_id, support, confidence, lift, {_gr_out('growth_rate')} AS growth_rate, "
                 "is_jumping")
    scored = f"""
cap AS (SELECT coalesce(max(growth_rate) FILTER (WHERE growth_rate <> {INF}), {_d(10.0)}) * {_d(1.5)} AS cap
        FROM nonred),
scored AS (SELECT n.*, (n.confidence * 100) + ((CASE WHEN n.growth_rate = {INF} THEN cap.cap
           ELSE n.growth_rate END) * {_d(2.0)}) + (n.support * 2000) AS rep_score FROM nonred n CROSS JOIN cap)"""
    ranked_cols = (f"entity_id, label_id, label_name, {ANTE}, rule_confidence, "
                   f"{_gr_out('rule_growth_rate')} AS rule_growth_rate, is_hit, coalesce(s.t, 'indirect') AS bridge_text")
    from_top = "FROM {} LEFT JOIN bsets s USING (entity_id, label_id)"
    top_conf = f"SELECT * FROM dedup ORDER BY rule_confidence DESC, entity_id, label_id LIMIT {p.show}"
    top_gr = (f"SELECT * FROM dedup ORDER BY rule_growth_rate DESC, rule_confidence DESC, entity_id, label_id "
              f"LIMIT {p.show}")
    q: dict[str, str] = {}
    q["entity_features"] = _with(base) + (
        " SELECT entity_id, entity_name, array_to_string(features, ' ') AS features, "
        "CAST(len(features) AS INTEGER) AS n_features FROM ent")
    q["entity_bridge"] = ("SELECT DISTINCT l_partkey AS entity_id, CAST(l_suppkey AS VARCHAR) AS bridge_item "
                          "FROM lineitem")
    q["label_bridge_by_id"] = _with(base) + " SELECT DISTINCT label_key, bridge_item FROM bridge_rows"
    q["label_bridge_by_name"] = _with(base) + (
        " SELECT DISTINCT lower(label_name) AS name_key, bridge_item FROM bridge_rows WHERE label_name IS NOT NULL")
    q["label_names"] = _with(base) + " SELECT label_id, label_name FROM labels"
    q["class_counts"] = _with(base) + (
        " SELECT class, split, count(*) AS n_rows FROM assoc GROUP BY class, split")
    q["split_hash"] = _with(base) + " SELECT order_key, line_number, class, split FROM assoc"
    q["split_exact"] = _with(base) + f""",
ranked AS (SELECT order_key, line_number, class,
  row_number() OVER (PARTITION BY class ORDER BY md5(concat_ws('-', CAST(order_key AS VARCHAR),
      CAST(line_number AS VARCHAR), CAST(entity_id AS VARCHAR))), order_key, line_number) AS rn,
  count(*) OVER (PARTITION BY class) AS n FROM assoc)
SELECT order_key, line_number, class,
  CASE WHEN rn <= ceil({_d(p.test_percent / 100.0)} * CAST(n AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
FROM ranked"""
    tx_text = ("SELECT entity_id, label_id, CAST(multiplicity AS BIGINT) AS multiplicity, "
               "array_to_string(list_sort(list_distinct(list_concat(features, "
               "['LABEL_' || CAST(label_id AS VARCHAR)]))), ' ') AS items FROM {t}")
    q["transactions_pos"] = _with(base) + " " + tx_text.format(t="txp")
    q["transactions_neg"] = _with(base) + " " + tx_text.format(t="txn")
    q["item_frequency"] = _with(base) + """
SELECT item, CAST(sum(multiplicity) AS BIGINT) AS frequency FROM (
  SELECT unnest(features) AS item, multiplicity FROM txp
  UNION ALL SELECT 'LABEL_' || CAST(label_id AS VARCHAR), multiplicity FROM txp) GROUP BY item"""
    q["vocabulary_stats"] = _with(base, _pruned(p.prune_support, "r")) + """
SELECT
  (SELECT CAST(count(DISTINCT item) AS BIGINT) FROM (SELECT unnest(features) AS item FROM txp
     UNION ALL SELECT 'LABEL_' || CAST(label_id AS VARCHAR) FROM txp)) AS items_before,
  (SELECT CAST(count(*) AS BIGINT) FROM ffr) + (SELECT CAST(count(*) AS BIGINT) FROM lfr) AS items_after,
  (SELECT CAST(n AS BIGINT) FROM n_all) AS tx_before,
  (SELECT CAST(coalesce(sum(multiplicity), 0) AS BIGINT) FROM ptxr) AS tx_after"""
    q["pruned_transactions"] = _with(base, _pruned(p.prune_support, "r")) + " " + tx_text.format(t="ptxr")
    q["frequent_itemsets"] = _with(base, _pruned(p.min_support, "")) + f""",
npt AS (SELECT sum(multiplicity) AS n FROM ptx),
mc AS (SELECT ceil({_d(p.min_support)} * CAST(n AS DOUBLE)) AS c FROM npt),
it AS (SELECT list_concat(features, ['LABEL_' || CAST(label_id AS VARCHAR)]) AS items, multiplicity AS m FROM ptx),
sets AS (SELECT {_subsets('list_sort(items)')} AS items, m FROM it)
SELECT array_to_string(items, ' ') AS items, CAST(sum(m) AS BIGINT) AS freq FROM sets
GROUP BY items HAVING sum(m) >= (SELECT c FROM mc)"""
    q["label_rules_m2"] = mine + (f" SELECT {ANTE}, label_id, length, n_rule, n_ante, n_label, support, "
                                  "confidence, lift, leverage, conviction FROM rules")
    q["label_rules_m1"] = mine + f" SELECT {ANTE}, label_id, length, support, confidence, lift FROM rules"
    q["negative_support"] = contrast + (f" SELECT {ANTE}, label_id, n_neg_match, n_neg_total, support_neg "
                                        "FROM gr")
    q["growth_rate"] = contrast + (f" SELECT {ANTE}, label_id, support, support_neg, "
                                   f"{_gr_out('growth_rate')} AS growth_rate, is_jumping FROM gr")
    q["high_contrast_rules"] = contrast + f" SELECT {rule_cols} FROM high"
    q["nonredundant_rules"] = refined + f" SELECT {rule_cols} FROM nonred"
    q["rule_scores"] = refined + "," + scored + f" SELECT {ANTE}, label_id, rep_score FROM scored"
    q["representative_rules"] = refined + "," + scored + f""",
best AS (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY rep_score DESC, len(ante) ASC,
         array_to_string(ante, ' ') DESC) AS rn FROM scored)
SELECT label_id, {ANTE}, rep_score, confidence, support, {_gr_out('growth_rate')} AS growth_rate, is_jumping
FROM best WHERE rn = 1"""
    q["diverse_top_rules"] = refined + f""",
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY label_id ORDER BY growth_rate DESC, lift DESC,
       array_to_string(ante, ' ')) AS INTEGER) AS rank_in_label FROM nonred)
,
top AS (SELECT * FROM rk WHERE rank_in_label <= {p.max_per_label}
        ORDER BY growth_rate DESC, lift DESC, label_id, array_to_string(ante, ' ') LIMIT {p.top_n})
SELECT {ANTE}, label_id, {_gr_out('growth_rate')} AS growth_rate, is_jumping, lift, rank_in_label FROM top"""
    q["candidates"] = disc + (f" SELECT entity_id, label_id, {ANTE}, rule_confidence, "
                              f"{_gr_out('rule_growth_rate')} AS rule_growth_rate, is_hit, known_negative "
                              "FROM cand2")
    q["candidates_dedup"] = disc + (f" SELECT entity_id, entity_name, label_id, {ANTE}, rule_confidence, "
                                    f"{_gr_out('rule_growth_rate')} AS rule_growth_rate, rule_lift, is_hit, "
                                    "known_negative FROM dedup")
    q["bridge_evidence"] = disc + _EVIDENCE + """
SELECT d.entity_id, d.label_id, coalesce(s.t, 'indirect') AS bridge_text
FROM dedup d LEFT JOIN bsets s USING (entity_id, label_id)"""
    q["top_by_confidence"] = disc + _EVIDENCE + f", top AS ({top_conf}) SELECT {ranked_cols} {from_top.format('top')}"
    q["top_by_growth"] = disc + _EVIDENCE + f", top AS ({top_gr}) SELECT {ranked_cols} {from_top.format('top')}"
    long_tail = f"""
shown AS (SELECT label_id FROM ({top_conf}) UNION SELECT label_id FROM ({top_gr})),
rest AS (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY rule_confidence DESC, entity_id) AS rn2
         FROM dedup WHERE label_id NOT IN (SELECT label_id FROM shown)),
tail AS (SELECT * FROM rest WHERE rn2 = 1 ORDER BY rule_confidence DESC, entity_id, label_id LIMIT {p.show})"""
    q["long_tail"] = disc + _EVIDENCE + "," + long_tail + f" SELECT {ranked_cols} {from_top.format('tail')}"
    top_rep = f"""
best AS (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY rep_score DESC, len(ante) ASC,
         array_to_string(ante, ' ') DESC) AS rn FROM scored)
SELECT CAST(row_number() OVER (ORDER BY rep_score DESC, label_id) AS INTEGER) AS place, label_id, {ANTE}, rep_score,
  confidence, support, {_gr_out('growth_rate')} AS growth_rate, is_jumping
FROM best WHERE rn = 1 ORDER BY rep_score DESC, label_id LIMIT {p.top_n}"""
    q["representative_top"] = refined + "," + scored + "," + top_rep
    best = _best(p, base)
    q["sweep_best_rules"] = best + f" SELECT {rule_cols} FROM nonred"
    best_disc = best + "," + _discovery()
    q["sweep_best_candidates"] = best_disc + _EVIDENCE + (
        f" SELECT entity_id, entity_name, label_id, {ANTE}, rule_confidence, {_gr_out('rule_growth_rate')} AS "
        f"rule_growth_rate, is_hit, known_negative, coalesce(s.t, 'indirect') AS bridge_text {from_top.format('dedup')}")
    q["sweep_best_rankings"] = best_disc + _EVIDENCE + "," + long_tail + "," + f"""
t1 AS ({top_conf}), t2 AS ({top_gr})
SELECT {ranked_cols}, 'top_by_confidence' AS ranking {from_top.format('t1')}
UNION ALL SELECT {ranked_cols}, 'top_by_growth' AS ranking {from_top.format('t2')}
UNION ALL SELECT {ranked_cols}, 'long_tail' AS ranking {from_top.format('tail')}"""
    q["sweep_best_representatives"] = best + "," + scored + "," + top_rep
    q["prefix_candidates"] = refined + """,
r AS (SELECT label_id, list_filter(ante, lambda x: x LIKE 'BRAND\\_%' ESCAPE '\\' OR x LIKE 'TYPE\\_%' ESCAPE '\\') AS a
      FROM nonred),
m AS (SELECT e.entity_id, r.label_id FROM r JOIN ent e ON len(r.a) > 0 AND list_has_all(e.features, r.a)
      WHERE NOT EXISTS (SELECT 1 FROM pp WHERE pp.entity_id = e.entity_id AND pp.label_id = r.label_id))
SELECT m.entity_id, m.label_id, count(*) AS n_rules, EXISTS (SELECT 1 FROM tp WHERE tp.entity_id = m.entity_id
  AND tp.label_id = m.label_id) AS is_hit FROM m GROUP BY m.entity_id, m.label_id""".replace("\\\\", "\\")
    q["bridge_arms"] = _with(base) + """,
k AS (SELECT DISTINCT label_key FROM bridge_rows WHERE label_key NOT LIKE '%7'),
nm AS (SELECT DISTINCT lower(label_name) AS n FROM bridge_rows WHERE label_key LIKE '%7'),
l AS (SELECT ('MESH:' || label_id) IN (SELECT label_key FROM k) AS i, lower(label_name) IN (SELECT n FROM nm) AS m FROM labels)
SELECT count(*) AS n_labels, count(*) FILTER (WHERE i) AS by_id, count(*) FILTER (WHERE NOT i AND m) AS by_name,
  count(*) FILTER (WHERE NOT i AND NOT m) AS unmatched FROM l"""
    q["bridge_case"] = _with(base) + """,
eb AS (SELECT DISTINCT l_partkey AS entity_id, l_suppkey FROM lineitem),
lb AS (SELECT s_nationkey AS label_id, s_suppkey FROM supplier),
x AS (SELECT t.entity_id, t.label_id, list('SUP' || eb.l_suppkey || 'ORF') AS b FROM tp t JOIN eb USING (entity_id)
      JOIN lb ON lb.label_id = t.label_id AND lb.s_suppkey = eb.l_suppkey GROUP BY t.entity_id, t.label_id)
SELECT tp.entity_id, tp.label_id, coalesce(array_to_string(list_sort(x.b), ', '), 'indirect') AS bridge_text
FROM tp LEFT JOIN x USING (entity_id, label_id)"""
    q["split_sink"] = _with(base) + (
        " SELECT order_key, line_number, entity_id, label_id, label_name, status, class, split FROM assoc"
        " WHERE class = 'negative'")
    q["rule_sink"] = refined + (f" SELECT array_to_string(list_sort(ante), ', ') AS antecedent, label_id, support, confidence, "
                                f"lift, {_gr_out('growth_rate')} AS growth_rate, is_jumping FROM nonred")
    q["candidate_sink"] = disc + _EVIDENCE + (
        " SELECT entity_id, label_id, array_to_string(list_sort(ante), ', ') AS antecedent, rule_confidence, is_hit, "
        f"coalesce(s.t, 'indirect') AS bridge_text {from_top.format('dedup')}")
    q["csv_quoted"] = """
SELECT CAST(p_partkey AS VARCHAR) AS entity_id, 'he said "' || p_name || '", ok' AS label_name,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS label_id, 'Approved' AS status,
  CASE WHEN p_partkey % 3 = 0 THEN '"' ELSE 'z,' END AS phase FROM part"""
    q["tsv_quoted"] = """
SELECT p_brand AS bridge_item, 'the "' || p_name || '" name' AS label_name, 'MESH:' || p_partkey AS label_key
FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 4 <> 1 AND p_partkey % 6 <> 1"""
    q["xml_nested_genes"] = """
SELECT 'P' || p_partkey AS entity_id, CASE WHEN p_partkey % 5 = 0 THEN 'P' || p_partkey ELSE p_name END AS entity_name,
  'TARGET_' || replace(p_brand, ' ', '_') AS features,
  'A' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN ', B1' ELSE '' END AS bridge FROM part"""
    q["holdout_summary"] = disc + """,
reach AS (SELECT count(*) AS n FROM tp WHERE NOT EXISTS (
            SELECT 1 FROM pp WHERE pp.entity_id = tp.entity_id AND pp.label_id = tp.label_id)),
hs AS (SELECT CAST(count(*) AS BIGINT) AS n_candidates, CAST(count(*) FILTER (WHERE is_hit) AS BIGINT) AS hits,
         CAST(count(*) FILTER (WHERE NOT is_hit) AS BIGINT) AS novel FROM dedup)
SELECT hs.*, CASE WHEN n_candidates > 0 THEN CAST(hits AS DOUBLE) / CAST(n_candidates AS DOUBLE) END AS precision,
  CASE WHEN reach.n > 0 THEN CAST(hits AS DOUBLE) / CAST(reach.n AS DOUBLE) END AS recall
FROM hs CROSS JOIN reach"""
    q["sweep_report"] = _sweep_sql(p, base)
    q["sweep_best"] = _sweep_sql(p, base, best=True)
    q["xml_entity_scan"] = """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS entity_id, p_name AS entity_name,
  array_to_string(['TARGET_' || replace(p_brand, ' ', '_'),
                   'TARGET_' || replace(p_type || ' ' || CAST(p_size AS VARCHAR), ' ', '_'),
                   'TARGET_' || replace(p_name, ' ', '_')], ' ') AS features,
  array_to_string(list_sort(list_distinct([upper(p_type), 'S' || CAST(p_size AS VARCHAR)])), ', ') AS bridge
FROM part"""
    q["xml_file_scan"] = q["xml_last_record"] = q["xml_entity_scan"]
    q["vocabulary_sketches"] = _with(base) + """,
vocab AS (SELECT a.class, a.split, unnest(list_concat(e.features, ['LABEL_' || a.label_id])) AS item
          FROM (SELECT DISTINCT class, split, entity_id, label_id FROM assoc) a JOIN ent e USING (entity_id)
          WHERE len(e.features) > 0)
SELECT class, split, count(DISTINCT item) AS n_items, true AS within_band FROM vocab
GROUP BY GROUPING SETS ((class, split), (class), ())"""
    q["xml_layouts"] = q["xml_nested_genes"]
    q["label_names_last"] = """
SELECT p_brand AS label_id, arg_max(p_name, p_partkey) AS label_name FROM part WHERE p_partkey % 9 <> 0 GROUP BY p_brand"""
    q["csv_files_by_name"] = """
SELECT CAST(p_partkey AS VARCHAR) AS entity_id, p_name AS label_name, p_brand AS label_id, 'Approved' AS status,
  CASE WHEN p_partkey % 3 <> 2 THEN p_type END AS phase FROM part"""
    q["csv_roundtrip"] = _with(base) + " SELECT bridge_item, label_name, label_key FROM bridge_rows"
    q["assoc_csv_roundtrip"] = _with(base) + (
        " SELECT CAST(entity_id AS VARCHAR) AS entity_id, CAST(label_id AS VARCHAR) AS label_id, label_name, status,"
        " concat_ws('-', CAST(order_key AS VARCHAR), CAST(line_number AS VARCHAR), CAST(entity_id AS VARCHAR)) AS NCT"
        " FROM assoc_all")
    q["display_items"] = refined + f"""
SELECT {ANTE}, n.label_id,
  array_to_string(list_transform(list_sort(ante), lambda x: '[' || x || ']'), ', ') AS antecedent_display,
  '【' || lb.label_name || '】' AS label_display,
  CASE WHEN growth_rate = {INF} THEN '∞' ELSE format('{{:.2f}}', growth_rate) END AS growth_display
FROM nonred n LEFT JOIN labels lb USING (label_id)"""
    return q


def _sweep_ctes(p: Params, base: str) -> list[str]:
    parts = [base]
    selects = []
    highs = []
    confs = ", ".join(f"({i}, {_d(c)})" for i, c in enumerate(p.sweep_confidences))
    parts.append(f"\ngrid(conf_idx, conf) AS (VALUES {confs})")
    min_conf = min(p.sweep_confidences)
    for si, s in enumerate(p.sweep_supports):
        x = f"_s{si}"
        parts.append(_pruned(s, x))
        parts.append(_rules(s, min_conf, x))
        parts.append(_contrast(p.min_growth, x))
        parts.append(f"""
pairs{x} AS (
  SELECT e.entity_id, r.label_id, max(r.confidence) AS best FROM high{x} r JOIN ent e ON list_has_all(e.features, r.ante)
  WHERE NOT EXISTS (SELECT 1 FROM pp WHERE pp.entity_id = e.entity_id AND pp.label_id = r.label_id)
  GROUP BY e.entity_id, r.label_id),
cell{x} AS (
  SELECT {si} AS supp_idx, g.conf_idx, {_d(s)} AS supp, g.conf,
    (SELECT count(*) FROM rules{x} WHERE confidence >= g.conf) AS n_mined,
    (SELECT count(*) FROM high{x} WHERE confidence >= g.conf) AS n_rules,
    (SELECT count(*) FROM pairs{x} pr WHERE pr.best >= g.conf AND EXISTS (
        SELECT 1 FROM tp WHERE tp.entity_id = pr.entity_id AND tp.label_id = pr.label_id)) AS hits,
    (SELECT count(*) FROM pairs{x} pr WHERE pr.best >= g.conf AND NOT EXISTS (
        SELECT 1 FROM tp WHERE tp.entity_id = pr.entity_id AND tp.label_id = pr.label_id)) AS novel
  FROM grid g)""")
        selects.append(f"SELECT * FROM cell{x}")
        highs.append(f"SELECT {si} AS supp_idx, * FROM high{x}")
    parts.append("\nallcells AS (" + " UNION ALL ".join(selects) + ")")
    parts.append("\nhall AS (" + " UNION ALL ".join(highs) + ")")
    parts.append("""
report0 AS (SELECT CAST(supp_idx AS INTEGER) AS supp_idx, CAST(conf_idx AS INTEGER) AS conf_idx, supp, conf,
  CAST(CASE WHEN n_mined = 0 THEN 0 ELSE n_rules END AS BIGINT) AS n_rules, CAST(hits AS BIGINT) AS hits,
  CAST(novel AS BIGINT) AS novel, CASE WHEN n_mined = 0 THEN 'no_rules' ELSE 'ok' END AS status
  FROM allcells),
report AS (SELECT *, CAST(hits * 10000 + n_rules AS BIGINT) AS score FROM report0),
bestc AS (SELECT * FROM report ORDER BY score DESC, supp_idx, conf_idx LIMIT 1)""")
    return parts


def _sweep_sql(p: Params, base: str, best: bool = False) -> str:
    sql = _with(*_sweep_ctes(p, base))
    if best:
        return sql + " SELECT * FROM bestc"
    return sql + " SELECT * FROM report"


def _best(p: Params, base: str) -> str:
    """The best cell's high-contrast rules and what is left without redundant ones -> high, nonred."""
    parts = _sweep_ctes(p, base)
    parts.append("""
high AS (SELECT h.* EXCLUDE (supp_idx) FROM hall h JOIN bestc b ON h.supp_idx = b.supp_idx
         WHERE h.confidence >= b.conf AND b.status = 'ok')""")
    parts.append(_nonred(p))
    return _with(*parts)


#: Bridge items that a de-duplicated candidate's entity and label share -> bsets.
_EVIDENCE = """,
has_id AS (SELECT DISTINCT label_key FROM bridge_rows),
lab AS (SELECT label_id, label_name, CASE WHEN CAST(label_id AS VARCHAR) LIKE 'MESH:%' THEN CAST(label_id AS VARCHAR)
        ELSE 'MESH:' || CAST(label_id AS VARCHAR) END AS idk, lower(label_name) AS nk FROM labels),
lbl AS (
  SELECT DISTINCT lab.label_id, b.bridge_item FROM lab JOIN bridge_rows b ON b.label_key = lab.idk
  UNION
  SELECT DISTINCT lab.label_id, b.bridge_item FROM lab JOIN bridge_rows b ON lower(b.label_name) = lab.nk
  WHERE lab.idk NOT IN (SELECT label_key FROM has_id)),
eb AS (SELECT DISTINCT l_partkey AS entity_id, CAST(l_suppkey AS VARCHAR) AS bridge_item FROM lineitem),
shared AS (SELECT d.entity_id, d.label_id, eb.bridge_item FROM dedup d JOIN eb USING (entity_id)
           JOIN lbl ON lbl.label_id = d.label_id AND lbl.bridge_item = eb.bridge_item),
bsets AS (SELECT entity_id, label_id, array_to_string(list_sort(list(bridge_item)), ', ') AS t
         FROM shared GROUP BY entity_id, label_id)"""
