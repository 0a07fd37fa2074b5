"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Output rules (shared with the SQL oracle): item sets are sorted and joined to
text, every computed column is aliased, +inf growth rates are reported as NULL
together with ``is_jumping``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emergent.functions.items import INF, display_item, growth_text, items_text
from emergent.operators import discover, refine, split, sweep, transactions
from emergent.plans.flow import PARAMS, flow
from emergent.session import reliable, scratch_path
from emergent.sources import delimited, sinks, standin, xml


def _gr(c: str) -> Column:
    return F.when(F.col(c) == F.lit(INF), F.lit(None).cast("double")).otherwise(F.col(c))


def _ante() -> Column:
    return items_text("antecedent").alias("antecedent")


def q_entity_features(spark: SparkSession, d: str) -> DataFrame:
    e = flow(spark, d).entities
    return e.select("entity_id", "entity_name", items_text("features").alias("features"),
                    F.size("features").alias("n_features"))


def q_entity_bridge(spark: SparkSession, d: str) -> DataFrame:
    return flow(spark, d).entity_bridge


def q_label_bridge_by_id(spark: SparkSession, d: str) -> DataFrame:
    return discover.bridge_by_id(flow(spark, d).bridge_rows)


def q_label_bridge_by_name(spark: SparkSession, d: str) -> DataFrame:
    return discover.bridge_by_name(flow(spark, d).bridge_rows)


def q_label_names(spark: SparkSession, d: str) -> DataFrame:
    return flow(spark, d).label_names


def q_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return split.class_counts(flow(spark, d).assoc)


def q_split_hash(spark: SparkSession, d: str) -> DataFrame:
    return flow(spark, d).assoc.select("order_key", "line_number", "class", "split")


def q_split_exact(spark: SparkSession, d: str) -> DataFrame:
    f = flow(spark, d)
    cls = split.classify(f.assoc_all, positive=standin.POSITIVE_STATUS, negative=standin.NEGATIVE_STATUS)
    keyed = cls.withColumn("_h", F.md5(F.col("split_key")))
    out = split.exact_split(keyed, [F.col("_h"), F.col("order_key"), F.col("line_number")],
                            test_fraction=PARAMS.test_percent / 100.0)
    return out.select("order_key", "line_number", "class", "split")


def _tx_text(tx: DataFrame) -> DataFrame:
    t = transactions.transaction_items(tx, label_prefix=standin.LABEL_PREFIX)
    return t.select("entity_id", "label_id", "multiplicity", F.array_join("items", " ").alias("items"))


def q_transactions_pos(spark: SparkSession, d: str) -> DataFrame:
    return _tx_text(flow(spark, d).tx_pos)


def q_transactions_neg(spark: SparkSession, d: str) -> DataFrame:
    return _tx_text(flow(spark, d).tx_neg)


def q_item_frequency(spark: SparkSession, d: str) -> DataFrame:
    return transactions.item_frequency(flow(spark, d).tx_pos, label_prefix=standin.LABEL_PREFIX).select(
        "item", F.col("frequency").cast("bigint").alias("frequency"))


def q_vocabulary_stats(spark: SparkSession, d: str) -> DataFrame:
    f = flow(spark, d)
    return transactions.vocabulary_stats(f.tx_pos, f.pruned_for_report)


def q_vocabulary_sketches(spark: SparkSession, d: str) -> DataFrame:
    """A5 at scale: items per class and split, per class and in all, from stored sketches; the estimates are held
    against exact counts, and each must be within the sketch's error band."""
    f = flow(spark, d)
    pairs = f.pair_table.filter("class IS NOT NULL").select("class", "split", "entity_id", "label_id").distinct()
    tx = pairs.join(f.entities.select("entity_id", "features").filter(F.size("features") > 0), "entity_id")
    stored = reliable(transactions.vocabulary_sketches(tx, ["class", "split"], label_prefix=standin.LABEL_PREFIX), "sketches")
    every = F.lit(None).cast("string")
    estimates = (transactions.merged_vocabulary(stored, ["class", "split"])
                 .unionByName(transactions.merged_vocabulary(stored, ["class"]).withColumn("split", every))
                 .unionByName(transactions.merged_vocabulary(stored).withColumn("class", every).withColumn("split", every)))
    items = tx.select("class", "split", F.explode(F.concat("features", F.array(F.concat(
        F.lit(standin.LABEL_PREFIX), F.col("label_id").cast("string"))))).alias("item")).distinct()
    exact = items.groupingSets([["class", "split"], ["class"], []], "class", "split").agg(
        F.countDistinct("item").alias("n_items"))
    on = F.col("e.class").eqNullSafe(F.col("x.class")) & F.col("e.split").eqNullSafe(F.col("x.split"))
    close = F.abs(F.col("items") - F.col("n_items")) <= F.lit(transactions.SKETCH_BAND) * F.col("n_items")
    return exact.alias("x").join(estimates.alias("e"), on, "left").select(
        "x.class", "x.split", "n_items", F.coalesce(close, F.lit(False)).alias("within_band"))


def q_pruned_transactions(spark: SparkSession, d: str) -> DataFrame:
    return _tx_text(flow(spark, d).pruned_for_report.tx)


def q_frequent_itemsets(spark: SparkSession, d: str) -> DataFrame:
    itemsets, _ = flow(spark, d).fpgrowth
    return itemsets.select(F.array_join("items", " ").alias("items"), "freq")


def q_label_rules_m1(spark: SparkSession, d: str) -> DataFrame:
    _, rules = flow(spark, d).fpgrowth
    return rules.select(_ante(), "label_id", "length", "support", "confidence", "lift")


def q_label_rules_m2(spark: SparkSession, d: str) -> DataFrame:
    r = flow(spark, d).rules
    return r.select(_ante(), "label_id", "length", "n_rule", "n_ante", "n_label", "support",
                    "confidence", "lift", "leverage", _gr("conviction").alias("conviction"))


def q_negative_support(spark: SparkSession, d: str) -> DataFrame:
    c = flow(spark, d).contrast
    return c.select(_ante(), "label_id", "n_neg_match", "n_neg_total", "support_neg")


def q_growth_rate(spark: SparkSession, d: str) -> DataFrame:
    c = flow(spark, d).contrast
    return c.select(_ante(), "label_id", "support", "support_neg", _gr("growth_rate").alias("growth_rate"),
                    "is_jumping")


def _rule_out(df: DataFrame) -> DataFrame:
    return df.select(_ante(), "label_id", "support", "confidence", "lift",
                     _gr("growth_rate").alias("growth_rate"), "is_jumping")


def q_high_contrast_rules(spark: SparkSession, d: str) -> DataFrame:
    return _rule_out(flow(spark, d).high)


def q_nonredundant_rules(spark: SparkSession, d: str) -> DataFrame:
    return _rule_out(flow(spark, d).nonredundant)


def q_rule_scores(spark: SparkSession, d: str) -> DataFrame:
    s = refine.score_rules(flow(spark, d).nonredundant)
    return s.select(_ante(), "label_id", "rep_score")


def q_representative_rules(spark: SparkSession, d: str) -> DataFrame:
    r = refine.representative_rules(flow(spark, d).nonredundant)
    return r.select("label_id", _ante(), "rep_score", "confidence", "support",
                    _gr("growth_rate").alias("growth_rate"), "is_jumping")


def q_diverse_top_rules(spark: SparkSession, d: str) -> DataFrame:
    r = refine.diverse_top_rules(flow(spark, d).nonredundant, PARAMS.top_n, PARAMS.max_per_label)
    return r.select(_ante(), "label_id", _gr("growth_rate").alias("growth_rate"), "is_jumping", "lift",
                    "rank_in_label")


def q_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = flow(spark, d).candidates
    return c.select("entity_id", "label_id", _ante(), "rule_confidence",
                    _gr("rule_growth_rate").alias("rule_growth_rate"), "is_hit", "known_negative")


def q_candidates_dedup(spark: SparkSession, d: str) -> DataFrame:
    c = flow(spark, d).candidates_dedup
    return c.select("entity_id", "entity_name", "label_id", _ante(), "rule_confidence",
                    _gr("rule_growth_rate").alias("rule_growth_rate"), "rule_lift", "is_hit",
                    "known_negative")


def q_bridge_evidence(spark: SparkSession, d: str) -> DataFrame:
    f = flow(spark, d)
    ev = f.with_evidence(f.candidates_dedup)
    return ev.select("entity_id", "label_id", "bridge_text")


def _ranked_out(df: DataFrame) -> DataFrame:
    return df.select("entity_id", "label_id", "label_name", _ante(), "rule_confidence",
                     _gr("rule_growth_rate").alias("rule_growth_rate"), "is_hit", "bridge_text")


def q_top_by_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_out(flow(spark, d).results["top_by_confidence"])


def q_top_by_growth(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_out(flow(spark, d).results["top_by_growth"])


def q_long_tail(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_out(flow(spark, d).results["long_tail"])


def _top_rep_out(df: DataFrame) -> DataFrame:
    """R3 + O5, with its place in the order."""
    w = Window.orderBy(F.col("rep_score").desc(), F.col("label_id").asc())  # top_n rows
    return df.select(F.row_number().over(w).alias("place"), "label_id", _ante(), "rep_score", "confidence", "support",
                     _gr("growth_rate").alias("growth_rate"), "is_jumping")


def q_representative_top(spark: SparkSession, d: str) -> DataFrame:
    return _top_rep_out(flow(spark, d).results["representative_rules"])


def q_prefix_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Only brand and type items of a rule's antecedent count."""
    f = flow(spark, d)
    c = discover.candidates(f.nonredundant, f.entities, f.pos_train_pairs, f.pos_test_pairs,
                            prefixes=("BRAND_", "TYPE_"))
    return c.groupBy("entity_id", "label_id").agg(F.count(F.lit(1)).alias("n_rules"), F.max("is_hit").alias("is_hit"))


def q_bridge_arms(spark: SparkSession, d: str) -> DataFrame:
    """Q-14: how many labels J3 finds by id and by name."""
    f = flow(spark, d)
    rows = f.bridge_rows.withColumn("label_key", F.when(F.col("label_key").endswith("7"), F.lit("MESH:none"))
                                    .otherwise(F.col("label_key")))
    rows = rows.withColumn("label_name", F.when(F.col("label_key") == "MESH:none", F.lower("label_name")))
    return discover.bridge_arms(f.label_names, discover.bridge_by_id(rows), discover.bridge_by_name(rows))


def q_holdout_summary(spark: SparkSession, d: str) -> DataFrame:
    f = flow(spark, d)
    return discover.holdout_summary(f.candidates_dedup, f.pos_test_pairs, f.pos_train_pairs)


def _sweep_result(spark: SparkSession, d: str) -> sweep.SweepResult:
    return flow(spark, d).sweep_result


def _sweep(spark: SparkSession, d: str) -> DataFrame:
    return _sweep_result(spark, d).report


def q_sweep_best_rules(spark: SparkSession, d: str) -> DataFrame:
    """Non-redundant rules of the best sweep cell (what the downstream steps consume)."""
    return _rule_out(flow(spark, d).best_results["rules"])


def q_sweep_best_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the best cell's rules, with evidence."""
    c = flow(spark, d).best_results["candidates"]
    return c.select("entity_id", "entity_name", "label_id", _ante(), "rule_confidence",
                    _gr("rule_growth_rate").alias("rule_growth_rate"), "is_hit", "known_negative", "bridge_text")


def q_sweep_best_rankings(spark: SparkSession, d: str) -> DataFrame:
    """The three rankings of the best cell, one under another."""
    t = flow(spark, d).best_results
    parts = [_ranked_out(t[n]).withColumn("ranking", F.lit(n)) for n in ("top_by_confidence", "top_by_growth", "long_tail")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_sweep_best_representatives(spark: SparkSession, d: str) -> DataFrame:
    return _top_rep_out(flow(spark, d).best_results["representative_rules"])


def q_sweep_report(spark: SparkSession, d: str) -> DataFrame:
    return _sweep(spark, d)


def q_sweep_best(spark: SparkSession, d: str) -> DataFrame:
    return sweep.best_cell(_sweep(spark, d))


def standin_entity_xml(part: DataFrame) -> DataFrame:
    """XML text of one record per part (built on the executors, one row each)."""
    def esc(c: Column) -> Column:
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                         F.lit(">"), F.lit("&gt;"))

    key = F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    text = F.concat(
        F.lit("<drug type=\"part\">"),
        F.lit("<drugbank-id primary=\"true\">P"), key, F.lit("</drugbank-id>"),
        F.lit("<drugbank-id>ALT-"), key, F.lit("</drugbank-id>"),
        F.lit("<name>"), esc(F.col("p_name")), F.lit("</name>"),
        F.lit("<targets>"),
        F.lit("<target><name>"), esc(F.col("p_brand")), F.lit("</name><polypeptide><gene-name>"),
        F.lower(esc(F.col("p_type"))), F.lit("</gene-name></polypeptide></target>"),
        F.lit("<target><name>"), esc(F.col("p_type")), F.lit(" "), size, F.lit("</name></target>"),
        F.lit("<target><name>"), esc(F.col("p_name")), F.lit("</name><polypeptide><gene-name>s"), size,
        F.lit("</gene-name></polypeptide><polypeptide><gene-name>"), esc(F.col("p_type")),
        F.lit("</gene-name></polypeptide></target>"),
        F.lit("<target><name>"), esc(F.col("p_brand")), F.lit("</name></target>"),
        F.lit("</targets></drug>"))
    return part.select(text.alias("xml"))


def q_xml_entity_scan(spark: SparkSession, d: str) -> DataFrame:
    part = standin.table(spark, d, "part")
    ents = xml.parse_entity_xml(standin_entity_xml(standin.spread(part)), "xml")
    return ents.select("entity_id", "entity_name", F.array_join("features", " ").alias("features"),
                       F.array_join(F.array_sort("bridge"), ", ").alias("bridge"))


def _entity_out(ents: DataFrame) -> DataFrame:
    return ents.select("entity_id", "entity_name", F.array_join("features", " ").alias("features"),
                       F.array_join(F.array_sort("bridge"), ", ").alias("bridge"))


def q_xml_file_scan(spark: SparkSession, d: str) -> DataFrame:
    """S1 from files: one XML record per part written as text files, scanned by ``rowTag``."""
    path = scratch_path(spark, "entities-xml")
    sinks.write_xml_records(standin_entity_xml(standin.spread(standin.table(spark, d, "part"))), "xml", path)
    return _entity_out(xml.read_entity_xml(spark, path))


def _nested_xml(part: DataFrame) -> DataFrame:
    """Records with gene names at other depths, no name, several ids, a repeated id, a nested element of the row tag."""
    key = F.col("p_partkey").cast("string")
    even = F.col("p_partkey") % 2 == 0
    name = F.when(F.col("p_partkey") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<name>"), F.col("p_name"), F.lit("</name>")))
    text = F.concat(
        F.lit('<drug xmlns="http://example.org/x" type="part">\n  <drugbank-id>OLD'), key,
        F.lit('</drugbank-id>\n  <drugbank-id primary="true">P'), key, F.lit("</drugbank-id>"), name,
        F.lit("<targets><target><name>"), F.col("p_brand"), F.lit("</name><other><deep><gene-name>a"), key,
        F.lit("</gene-name></deep></other>"),
        F.when(even, F.lit("<polypeptide><synonyms><gene-name>b1</gene-name></synonyms></polypeptide>")).otherwise(F.lit("")),
        F.lit("</target><target><name></name><gene-name>A"), key, F.lit("</gene-name></target></targets>"),
        F.lit("<interactions>\n  <drug><name>other</name>\n  </drug>\n</interactions></drug>"))
    rows = part.select(text.alias("xml"))
    return rows.unionByName(part.filter("p_partkey % 3 = 0").select(text.alias("xml")))


def q_xml_nested_genes(spark: SparkSession, d: str) -> DataFrame:
    """S1, P1, P2, P4, P5 from files that hold nested genes, missing names and repeated ids."""
    path = scratch_path(spark, "nested-xml")
    sinks.write_xml_records(_nested_xml(standin.spread(standin.table(spark, d, "part"))), "xml", path, per_file=500)
    return _entity_out(xml.read_entity_xml(spark, path))


def q_xml_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Records by nesting depth, whatever the layout: indented, on one line, with row tags in comments and CDATA."""
    path = scratch_path(spark, "layout-xml")
    part = standin.spread(standin.table(spark, d, "part"))
    records = _nested_xml(part.filter("p_partkey % 2 = 0"))
    noted = records.select(F.concat(
        F.lit("<!-- <drug> </drug></drug> -->"), F.replace(
            F.col("xml"), F.lit("<targets>"), F.lit("<!-- </drug> <drug> --><note><![CDATA[</drug>]]></note><targets>")),
        F.lit("<drug/>")).alias("xml"))
    sinks.write_xml_records(records, "xml", f"{path}/a", per_file=300, layout="indented")
    sinks.write_xml_records(_nested_xml(part.filter("p_partkey % 4 = 1")), "xml", f"{path}/b", layout="one_line")
    sinks.write_xml_records(noted, "xml", f"{path}/c", per_file=1000, layout="one_line")
    sinks.write_xml_records(_nested_xml(part.filter("p_partkey % 4 = 3")), "xml", f"{path}/d", layout="indented")
    return _entity_out(xml.read_entity_xml(spark, [f"{path}/{x}" for x in "abcd"]))


def in_place_order(part: DataFrame) -> DataFrame:
    """Parts dealt to many tasks, those of one key to one task and in the order of the table."""
    return (part.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange("p_partkey")
            .sortWithinPartitions("p_partkey", "_place").drop("_place"))


def q_xml_last_record(spark: SparkSession, d: str) -> DataFrame:
    """P5 in input order: of the records of one id the last in the file counts, though an earlier one is greater."""
    path = scratch_path(spark, "repeated-xml")
    text = F.col("xml")
    earlier = F.regexp_replace(F.regexp_replace(text, "<name>", "<name>zz"), r"<target><name>[^<]*</name></target>", "")
    twice = standin_entity_xml(in_place_order(standin.table(spark, d, "part"))).select(F.explode(F.array(earlier, text)).alias("xml"))
    sinks.write_xml_records(twice, "xml", path)
    return _entity_out(xml.read_entity_xml(spark, path, duplicates="last"))


def q_csv_files_by_name(spark: SparkSession, d: str) -> DataFrame:
    """S3: files with other column orders, and a column that only some have, in one scan."""
    part = standin.table(spark, d, "part")
    path = scratch_path(spark, "named-csv")
    a = part.select(F.col("p_partkey").alias("drugbank_id"), F.col("p_name").alias("ind_name"),
                    F.col("p_brand").alias("ind_id"), F.lit("Approved").alias("status"), F.col("p_type").alias("phase"))
    orders = (a.columns, a.columns[::-1], ["status", "ind_id", "drugbank_id", "ind_name"])
    for i, columns in enumerate(orders):
        sinks.write_csv(a.filter(F.col("drugbank_id") % 3 == i).select(*columns), f"{path}/{i}")
    return delimited.read_associations_csv(spark, [f"{path}/{i}" for i in range(len(orders))])


def q_label_names_last(spark: SparkSession, d: str) -> DataFrame:
    """A3 in input order: of a label's names the last one in the files counts."""
    path = scratch_path(spark, "ordered-csv")
    part = standin.table(spark, d, "part")
    sinks.write_csv(part.select(F.col("p_partkey").alias("drugbank_id"), F.col("p_brand").alias("ind_id"),
                                F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("ind_name"),
                                F.lit("Approved").alias("status")).orderBy("drugbank_id"), path)
    return discover.label_names(delimited.read_associations_csv(spark, path, place="place"))


def q_assoc_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S3: associations written as a header CSV with the source's column names, read back."""
    a = flow(spark, d).assoc_all
    path = scratch_path(spark, "associations-csv")
    sinks.write_csv(a.select(F.col("entity_id").alias("drugbank_id"), F.col("label_name").alias("ind_name"),
                             F.col("label_id").alias("ind_id"), "status", F.col("split_key").alias("NCT")), path)
    back = delimited.read_associations_csv(spark, path)
    return back.select("entity_id", "label_id", "label_name", "status", "NCT")


def q_csv_quoted(spark: SparkSession, d: str) -> DataFrame:
    """S3: separators, doubled quotes and null tokens inside fields survive the file."""
    part = standin.table(spark, d, "part")
    path = scratch_path(spark, "quoted-csv")
    sinks.write_csv(part.select(
        F.col("p_partkey").alias("drugbank_id"),
        F.concat(F.lit('he said "'), F.col("p_name"), F.lit('", ok')).alias("ind_name"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("NA")).otherwise(F.col("p_brand")).alias("ind_id"),
        F.lit("Approved").alias("status"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit('"')).otherwise(F.lit("z,")).alias("phase")), path)
    return delimited.read_associations_csv(spark, path, null_tokens=delimited.SOURCE_NULL_TOKENS)


def q_tsv_quoted(spark: SparkSession, d: str) -> DataFrame:
    """S2 + F3: comments, quoted fields with doubled quotes, null tokens, another column order."""
    part = standin.table(spark, d, "part")
    path = scratch_path(spark, "quoted-tsv")
    tab = F.lit("\t")
    line = (F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("# "), F.col("p_name")))
            .otherwise(F.concat(
                F.when(F.col("p_partkey") % 4 == 1, F.lit("nan")).otherwise(F.col("p_brand")), tab, F.lit("x"), tab,
                F.lit('"the ""'), F.col("p_name"), F.lit('"" name"'), tab,
                F.when(F.col("p_partkey") % 6 == 1, F.lit("")).otherwise(F.concat(F.lit("MESH:"), F.col("p_partkey"))), tab,
                F.lit("rest"))))
    part.select(line.alias("value")).write.mode("overwrite").text(path)
    return delimited.read_label_bridge_tsv(spark, path, null_tokens=delimited.SOURCE_NULL_TOKENS)


def q_bridge_case(spark: SparkSession, d: str) -> DataFrame:
    """R6 + P7: symbols match whatever their case and prefix."""
    f = flow(spark, d)
    key = F.col("bridge_item").cast("bigint")
    ents = f.entity_bridge.withColumn("bridge_item", F.concat(F.lit("SuP"), F.col("bridge_item"), F.lit("orf")))
    labels = f.label_bridge.withColumn("bridge_item", F.when(key % 2 == 0, F.concat(
        F.lit("GENE_sup"), F.col("bridge_item"), F.lit("ORF"))).otherwise(
        F.concat(F.lit("sUP"), F.col("bridge_item"), F.lit("Orf"))))
    return discover.bridge_evidence(f.pos_test_pairs, ents, labels).select("entity_id", "label_id", "bridge_text")


def q_split_sink(spark: SparkSession, d: str) -> DataFrame:
    """K1: the class x split table written and read back, one class pruned to its folders."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(flow(spark, d).assoc.drop("split_key"), path)
    return spark.read.parquet(path).filter("class = 'negative'").select(
        "order_key", "line_number", "entity_id", "label_id", "label_name", "status", "class", "split")


def q_rule_sink(spark: SparkSession, d: str) -> DataFrame:
    """K2 + O2: the rule file, read back."""
    path = scratch_path(spark, "rules-csv")
    sinks.write_rules(_rule_out(flow(spark, d).nonredundant).withColumn("antecedent", F.split("antecedent", " ")), path,
                      fmt="csv")
    back = spark.read.option("header", "true").option("escape", '"').csv(path)
    return back.select("antecedent", F.col("label_id").cast("int"), *[F.col(c).cast("double") for c in (
        "support", "confidence", "lift", "growth_rate")], F.col("is_jumping").cast("boolean"))


def q_candidate_sink(spark: SparkSession, d: str) -> DataFrame:
    """K3: the candidate file, read back."""
    path = scratch_path(spark, "candidates-csv")
    cands = flow(spark, d).results["candidates"].drop("bridge")
    sinks.write_candidates(cands.withColumn("rule_growth_rate", _gr("rule_growth_rate")), path)
    back = spark.read.option("header", "true").option("escape", '"').csv(path)
    return back.select(F.col("entity_id").cast("bigint"), F.col("label_id").cast("int"), "antecedent",
                       F.col("rule_confidence").cast("double"), F.col("is_hit").cast("boolean"), "bridge_text")


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write the label-bridge rows as a headerless TSV (bridge, filler, name, key) and scan it back."""
    rows = flow(spark, d).bridge_rows
    path = scratch_path(spark, "label-bridge-tsv")
    (rows.select("bridge_item", F.lit("x").alias("filler"), "label_name", "label_key")
     .write.mode("overwrite").option("sep", "\t").option("header", "false").option("escape", '"').csv(path))
    return delimited.read_label_bridge_tsv(spark, path)


def q_display_items(spark: SparkSession, d: str) -> DataFrame:
    f = flow(spark, d)
    r = f.nonredundant.join(f.label_names, "label_id", "left")
    disp = F.array_join(F.transform(F.array_sort("antecedent"), lambda x: display_item(x)), ", ")
    return r.select(_ante(), "label_id", disp.alias("antecedent_display"),
                    display_item(F.concat(F.lit(standin.LABEL_PREFIX), F.col("label_id").cast("string")),
                                 F.col("label_name")).alias("label_display"),
                    growth_text("growth_rate").alias("growth_display"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "entity_features": q_entity_features,
    "entity_bridge": q_entity_bridge,
    "label_bridge_by_id": q_label_bridge_by_id,
    "label_bridge_by_name": q_label_bridge_by_name,
    "label_names": q_label_names,
    "class_counts": q_class_counts,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "transactions_pos": q_transactions_pos,
    "transactions_neg": q_transactions_neg,
    "item_frequency": q_item_frequency,
    "vocabulary_stats": q_vocabulary_stats,
    "vocabulary_sketches": q_vocabulary_sketches,
    "pruned_transactions": q_pruned_transactions,
    "frequent_itemsets": q_frequent_itemsets,
    "label_rules_m2": q_label_rules_m2,
    "label_rules_m1": q_label_rules_m1,
    "negative_support": q_negative_support,
    "growth_rate": q_growth_rate,
    "high_contrast_rules": q_high_contrast_rules,
    "nonredundant_rules": q_nonredundant_rules,
    "rule_scores": q_rule_scores,
    "representative_rules": q_representative_rules,
    "diverse_top_rules": q_diverse_top_rules,
    "candidates": q_candidates,
    "candidates_dedup": q_candidates_dedup,
    "bridge_evidence": q_bridge_evidence,
    "top_by_confidence": q_top_by_confidence,
    "top_by_growth": q_top_by_growth,
    "long_tail": q_long_tail,
    "holdout_summary": q_holdout_summary,
    "sweep_report": q_sweep_report,
    "sweep_best": q_sweep_best,
    "sweep_best_rules": q_sweep_best_rules,
    "xml_entity_scan": q_xml_entity_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "display_items": q_display_items,
    "xml_file_scan": q_xml_file_scan,
    "assoc_csv_roundtrip": q_assoc_csv_roundtrip,
    "representative_top": q_representative_top,
    "prefix_candidates": q_prefix_candidates,
    "bridge_arms": q_bridge_arms,
    "bridge_case": q_bridge_case,
    "sweep_best_candidates": q_sweep_best_candidates,
    "sweep_best_rankings": q_sweep_best_rankings,
    "sweep_best_representatives": q_sweep_best_representatives,
    "xml_nested_genes": q_xml_nested_genes,
    "xml_layouts": q_xml_layouts,
    "xml_last_record": q_xml_last_record,
    "label_names_last": q_label_names_last,
    "csv_files_by_name": q_csv_files_by_name,
    "csv_quoted": q_csv_quoted,
    "tsv_quoted": q_tsv_quoted,
    "split_sink": q_split_sink,
    "rule_sink": q_rule_sink,
    "candidate_sink": q_candidate_sink,
}
