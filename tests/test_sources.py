import os

import pytest
from pyspark.sql import functions as F

from emergent.operators import discover
from emergent.sources import delimited, sinks, xml

TOY_XML = """<?xml version="1.0" encoding="UTF-8"?>
<drugbank xmlns="http://www.drugbank.ca">
  <drug type="small">
    <drugbank-id primary="true">DB001</drugbank-id>
    <drugbank-id>ALT001</drugbank-id>
    <name>Alpha</name>
    <targets>
      <target><name>Kinase one</name><polypeptide><gene-name>abc1</gene-name></polypeptide></target>
      <target><name>Kinase one</name></target>
      <target><name>Receptor</name><polypeptide><gene-name>Def2</gene-name></polypeptide>
        <polypeptide><gene-name>ABC1</gene-name></polypeptide></target>
      <target><name></name></target>
    </targets>
    <pathways><pathway><drugs><drug><drugbank-id>DB999</drugbank-id><name>nested</name></drug></drugs></pathway></pathways>
  </drug>
  <drug type="small">
    <drugbank-id primary="true">DB002</drugbank-id>
    <name></name>
    <targets><target><name>Channel</name></target></targets>
  </drug>
  <drug type="small">
    <drugbank-id>DB003</drugbank-id>
    <name>No primary id</name>
  </drug>
  <drug type="small">
    <drugbank-id primary="true">DB004</drugbank-id>
    <name>No targets</name>
  </drug>
</drugbank>
"""


def test_entity_xml_scan(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "drugs.xml")
    with open(path, "w") as fh:
        fh.write(TOY_XML)
    ents = {r.entity_id: r for r in xml.read_entity_xml(spark, path).collect()}
    assert set(ents) == {"DB001", "DB002", "DB004"}          # no primary id -> dropped; nested not a row
    a = ents["DB001"]
    assert a.entity_name == "Alpha"
    assert a.features == ["TARGET_Kinase_one", "TARGET_Receptor"]
    assert sorted(a.bridge) == ["ABC1", "DEF2"]
    assert ents["DB002"].entity_name == "DB002"               # empty name falls back to the id
    assert ents["DB004"].features == [] and ents["DB004"].bridge == []


def test_label_bridge_tsv(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "genes.tsv")
    lines = [
        "# comment header",
        "GeneSymbol\tGeneID\tDiseaseName\tDiseaseID",
        "ABC1\t1\tFlu#A\tMESH:D1",
        "\t2\tFlu\tMESH:D1",
        "DEF2\t3\t\tMESH:D2",
        "GHI3\t4\tCold\t",
        "NA\t5\tcold\tMESH:D3",
    ]
    with open(path, "w") as fh:
        fh.write("\n".join(lines[:1] + lines[2:]) + "\n")
    rows = delimited.read_label_bridge_tsv(spark, path).collect()
    got = sorted((r.bridge_item, r.label_name, r.label_key) for r in rows if r.label_name is not None)
    assert ("ABC1", "Flu#A", "MESH:D1") in got                # '#' inside a line is kept
    assert ("NA", "cold", "MESH:D3") in got                   # 'NA' stays text unless asked for
    nulls = delimited.read_label_bridge_tsv(spark, path, null_tokens=delimited.SOURCE_NULL_TOKENS)
    assert nulls.filter("label_key = 'MESH:D3'").count() == 0
    assert all(r.bridge_item is not None and r.label_key is not None for r in rows)
    assert any(r.label_name is None for r in rows)            # null name kept
    by_name = discover.bridge_by_name(delimited.read_label_bridge_tsv(spark, path))
    assert by_name.filter(F.col("name_key") == "cold").count() == 1


def test_association_csv_and_sinks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "assoc.csv")
    with open(path, "w") as fh:
        fh.write("drug_name,drugbank_id,ind_name,ind_id,NCT,status\n"
                 "a,DB1,Flu,D1,n1,Approved\nb,DB2,Cold,D2,n2,Terminated\nc,DB1,Flu,D1,n3,Approved\n")
    df = delimited.read_associations_csv(spark, path)
    assert {"entity_id", "label_id", "label_name", "status", "NCT", "drug_name"} <= set(df.columns)
    assert df.count() == 3
    out = os.path.join(tmpdir_path, "split")
    sinks.write_splits(df.withColumn("class", F.lit("positive")).withColumn("split", F.lit("train")), out)
    back = spark.read.parquet(out)
    assert back.filter((F.col("class") == "positive") & (F.col("split") == "train")).count() == 3
    arr = spark.createDataFrame([(1, ["b", "a"])], "k int, items array<string>")
    sinks.write_csv(arr, os.path.join(tmpdir_path, "arr"))
    txt = spark.read.option("header", "true").csv(os.path.join(tmpdir_path, "arr")).first()["items"]
    assert txt == "a, b"


def test_xml_record_sink_round_trip_with_copies(spark, tmpdir_path):
    # A third of the records are identical copies: buckets still balance and every record comes back.
    rec = ('<drug><drugbank-id primary="true">{i}</drugbank-id><name>n</name>'
           '<targets><target><name>T {i}</name></target></targets></drug>')
    rows = [(rec.format(i="COPY"),)] * 300 + [(rec.format(i=f"D{i}"),) for i in range(600)]
    df = spark.createDataFrame(rows, "xml string").repartition(4)
    path = os.path.join(tmpdir_path, "xmlsink")
    sinks.write_xml_records(df, "xml", path, per_file=100)
    raw = spark.read.format("xml").option("rowTag", "drug").schema(xml.ENTITY_XML_SCHEMA).load(path)
    assert raw.count() == 900
    per_file = raw.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 9 and max(r["count"] for r in per_file) <= 100
    ents = {r.entity_id: r for r in xml.read_entity_xml(spark, path).collect()}
    assert len(ents) == 601 and ents["D5"].features == ["TARGET_T_D5"]


def test_one_large_xml_file_is_split_and_genes_are_found_at_any_depth(spark, tmpdir_path):
    rec = ('<drug type="x">\n  <drugbank-id primary="true">D{i}</drugbank-id><name>n</name><targets><target><name>T</name>'
           '<other><gene-name>g{i}</gene-name></other></target></targets>\n  <inner>\n    <drug><name>no</name>\n    </drug>\n'
           '  </inner>\n</drug>\n')
    path = os.path.join(tmpdir_path, "one.xml")
    with open(path, "w") as fh:
        fh.write('<?xml version="1.0"?>\n<drugbank xmlns="http://www.drugbank.ca">\n')
        fh.writelines(rec.format(i=i) for i in range(3000))
        fh.write("</drugbank>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert spark.read.option("lineSep", "\n</drug>").text(path).rdd.getNumPartitions() > 4
        got = xml.read_entity_xml(spark, path).select("entity_id", "bridge").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.entity_id: r.bridge for r in got} == {f"D{i}": [f"G{i}"] for i in range(3000)}


def test_malformed_csv_record_is_an_error(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bad.csv")
    with open(path, "w") as fh:
        fh.write('drugbank_id,ind_id,ind_name,status\nA,B,"x ""y"", z",Approved\nA,B\n')
    df = delimited.read_associations_csv(spark, path)
    with pytest.raises(Exception, match="malformed record"):
        df.collect()
    with open(path, "w") as fh:
        fh.write('drugbank_id,ind_id,ind_name,status\nA,B,"two\nlines",Approved\n')
    assert delimited.read_associations_csv(spark, path, multi_line=True).first()["label_name"] == "two\nlines"


def test_rule_file_is_in_order_of_lift(spark, tmpdir_path):
    rows = [(["a"], 1, 0.5), (["b"], 2, 3.0), (["c", "a"], 1, 1.5)]
    path = os.path.join(tmpdir_path, "rules")
    sinks.write_rules(spark.createDataFrame(rows, "antecedent array<string>, label_id int, lift double"), path, fmt="csv")
    parts = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    lifts = [float(line.rsplit(",", 1)[1]) for f in parts for line in open(os.path.join(path, f)).read().splitlines()[1:]]
    assert lifts == [3.0, 1.5, 0.5]


def _drug(i, body="", targets="<target><name>T</name></target>"):
    return f'<drug type="x"><drugbank-id primary="true">D{i}</drugbank-id><name>N{i}</name>{body}<targets>{targets}</targets></drug>'


def _layouts():
    nested = "<pathway><drugs><drug><name>in</name></drug><drug/></drugs></pathway><drug-interactions><drug-interaction>x</drug-interaction></drug-interactions>"
    plain = [_drug(i) for i in range(40)]
    deep = [_drug(i, nested * (i % 3)) for i in range(40)]
    return {
        "indented": "<drugbank>\n" + "\n".join("  " + p.replace("</drug>", "\n  </drug>") for p in plain) + "\n</drugbank>\n",
        "one_line": '<?xml version="1.0"?><drugbank xmlns="http://x.y/z">' + "".join(plain) + "</drugbank>",
        "one_indented": "<drugbank>\n" + "\n".join(p.replace("</drug>", "\n</drug>" if i != 7 else "\n  </drug>") for i, p in enumerate(plain)) + "\n</drugbank>",
        "nested_one_line": "<drugbank>" + " ".join(deep) + "</drugbank>",
        "spaced_end": "<drugbank>" + "".join(p[:-1] + " \n>" for p in deep) + "</drugbank>",
        "comments": "<drugbank><!-- <drug> --><!-- </drug><drug> </drug --><drug/>" + "<!-- </drug> -->".join(
            p.replace("<name>", "<!-- a <drug> b </drug> c --><name>").replace("<targets>", "<x><![CDATA[</drug> <drug><!--]]></x><targets>")
            for p in deep) + "<!-- <drug>\n</drug>\n<drug> --></drugbank>",
        "attributes": "<drugbank a='>' b=\"</x>\">" + "".join(p.replace('type="x"', "type='a>b' y=\"/>\"") for p in deep) + "<drug a='/' /></drugbank>",
    }


@pytest.mark.parametrize("layout,split", [(x, "300") for x in sorted(_layouts())] + [("one_indented", "64m"), ("comments", "64m")])
def test_xml_records_in_any_layout_and_any_cut(spark, tmpdir_path, layout, split):
    path = os.path.join(tmpdir_path, "a.xml")
    with open(path, "w") as fh:
        fh.write(_layouts()[layout])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        if split == "300":
            assert xml._pieces(spark, path, "drug").select("block").distinct().count() > 8
        assert xml.read_entity_xml(spark, path).count() == 40
        rows = xml.read_entity_xml(spark, path).collect()
        assert {(r.entity_id, r.entity_name, tuple(r.features)) for r in rows} == {
            (f"D{i}", f"N{i}", ("TARGET_T",)) for i in range(40)}
        texts = [r.xml for r in xml.read_xml_records(spark, path, "drug").orderBy("block", "row").collect()]
        assert [t[t.index('true">') + 6:].split("<")[0] for t in texts] == [f"D{i}" for i in range(40)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ["<r><drug>", "<r></drug></r>", "<r>" + _drug(1) + "</drug><drug></r>", "<r>" + _drug(1) + "<drug><name>x</name></r>"])
def test_unmatched_row_tags_are_an_error_under_column_pruning(spark, tmpdir_path, text):
    path = os.path.join(tmpdir_path, "a.xml")
    with open(path, "w") as fh:
        fh.write(text)
    with pytest.raises(Exception, match="do not match"):
        xml.read_entity_xml(spark, path).count()


def test_malformed_xml_record_is_an_error_under_column_pruning(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "a.xml")
    with open(path, "w") as fh:
        fh.write("<r>" + _drug(1) + _drug(2, "<a><b></a></b>") + "</r>")
    with pytest.raises(Exception, match="(?i)malformed|xml"):
        xml.read_entity_xml(spark, path).select("entity_id").collect()


def test_last_record_of_an_id_in_input_order(spark, tmpdir_path):
    rec = [_drug(1).replace("N1", n) for n in ("zeta", "alpha", "mid")]
    for name, order in (("a", rec), ("b", rec[::-1])):
        path = os.path.join(tmpdir_path, f"{name}.xml")
        with open(path, "w") as fh:
            fh.write("<r>" + " ".join(order) + " " * 400 + "</r>")
        assert xml.read_entity_xml(spark, path).first()["entity_name"] == "zeta"
        assert xml.read_entity_xml(spark, path, duplicates="last").first()["entity_name"] == ("mid" if name == "a" else "zeta")
    both = xml.read_entity_xml(spark, [os.path.join(tmpdir_path, f"{n}.xml") for n in "ba"], duplicates="last")
    assert both.first()["entity_name"] == "zeta"
    with pytest.raises(ValueError):
        xml.read_entity_xml(spark, path, duplicates="first")


def test_text_that_looks_like_a_namespace_is_kept(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "a.xml")
    with open(path, "w") as fh:
        fh.write("<r xmlns='u'>" + _drug(1).replace("N1", 'a xmlns="b" c:d="e" f').replace('type="x"', "type='x' xmlns:q='z' q:w='1'") + "</r>")
    assert xml.read_entity_xml(spark, path).first()["entity_name"] == 'a xmlns="b" c:d="e" f'


def test_csv_files_are_read_by_column_name(spark, tmpdir_path):
    def put(name, text):
        with open(os.path.join(tmpdir_path, name), "w") as fh:
            fh.write(text)

    put("a.csv", "drugbank_id,ind_id,ind_name,status,NCT\nE1,L1,Flu,Approved,n1\n")
    put("b c%20.csv", '\ufeffstatus,"ind_name",ind_id,drugbank_id\nTerminated,"Co,ld",L2,E2\n')
    put("empty.csv", "")
    df = delimited.read_associations_csv(spark, tmpdir_path)
    assert sorted(map(tuple, df.select("entity_id", "label_id", "label_name", "status", "NCT").collect())) == [
        ("E1", "L1", "Flu", "Approved", "n1"), ("E2", "L2", "Co,ld", "Terminated", None)]
    put("d.csv", "drugbank_id,ind_name,status\nE,Flu,Approved\n")
    with pytest.raises(ValueError, match="ind_id.*d.csv"):
        delimited.read_associations_csv(spark, tmpdir_path)
