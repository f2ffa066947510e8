"""Edge cases of the operators on small inputs."""

from pyspark.sql import functions as F

from fondscope import functions as S
from fondscope.operators import examples, language, numbering, selection, temporal, usage
from fondscope.plans import catalogues, composition
from fondscope.schema import ATTRIBUTE_SCHEMA, DATASETS, registry
from fondscope.sources import attributes, dimensions, harvest, inventory, nested, records


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


def table(spark, *data):
    return spark.createDataFrame(list(data), ATTRIBUTE_SCHEMA)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


def test_digits_and_years(spark):
    values = ["1650", "165", "0042", "99999999999", "1650\n", "١٦٥٠", "", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.value for r in selection.numeric_values(df).collect()] == values[:4]
    d = table(spark, *((k, 1, 1, "011@", "a", v) for k, v in enumerate(values)), (90, 1, 1, "008", "", "850101s1999"), (91, 1, 1, "008", "", "8501"), (92, 1, 1, "011@", "n", "1700"))
    assert rows(temporal.record_years(d), "record_number") == [(0, 1650), (1, 165), (2, 42), (3, None), (90, 1999)]
    assert rows(temporal.year_histogram(d, 100, 2000), "year") == [(165, 1), (1650, 1), (1999, 1)]
    assert temporal.records_without_year(d).first().n == len(values) - 4 + 2


def test_languages(spark):
    dim = spark.createDataFrame([("eng", "English"), ("eng", "English"), ("ger", "German")], dimensions.LANGUAGES)
    marc = "x" * 35
    d = table(spark, (1, 1, 1, "008", "", marc + "eng "), (2, 1, 1, "008", "", marc + "   "), (3, 1, 1, "010@", "a", "ger"), (3, 1, 2, "010@", "a", "zzz"), (4, 1, 1, "001", "", "4"))
    got = {r.language: (r.n, r.prop) for r in language.language_distribution(d, dim).collect()}
    assert got == {"eng (English)": (1, 0.2), "   ": (1, 0.2), "ger (German)": (1, 0.2), "zzz": (1, 0.2), None: (1, 0.2)}


def test_usage(spark):
    d = table(spark, (1, 1, 1, "700", "a", "x"), (1, 1, 2, "700", "b", "y"), (1, 2, 1, "700", "a", None), (2, 1, 1, "001", "", "k"))
    assert rows(usage.field_usage(d), "field_code") == [("001", 1, 0.5, 1, 1.0, 0), ("700", 1, 0.5, 3, 3.0, 1)]
    assert rows(usage.field_usage(d, unit="occurrence"), "field_code")[1] == ("700", 1, 0.5, 2, 2.0, 1)
    sub = rows(usage.subfield_usage(d), "field_code", "subfield_code")
    assert sub[1] == ("700", "a", 1, 0.5, 2, 2.0, 1, 1)
    assert usage.dataset_totals(d).first().asDict() == {"n_records": 2, "n_rows": 4}
    assert rows(usage.code_counts(d)) == [(2, 3)]
    empty = spark.createDataFrame([], ATTRIBUTE_SCHEMA)
    assert usage.field_usage(empty).count() == 0 and usage.dataset_totals(empty).first().n_rows == 0


def test_one_exchange_serves_both_groupings(spark):
    codes = usage.record_codes(table(spark, (1, 1, 1, "700", "a", "x")))
    plan = codes.groupBy("record_number", "field_code").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_examples(spark):
    d = table(spark, *((k, 1, 1, "700", "a", f"v{k % 20}") for k in range(100)))
    first, again = (examples.example_values(x).first().e_vals for x in (d, d.repartition(7)))
    assert first == again and len(first.split("|")) == 7 and all(v.endswith(" (5)") for v in first.split("|"))


def test_descriptions(spark, tmp_path):
    d = table(spark, (1, 1, 1, "700", "a", "x"), (1, 2, 1, "008", "", "y"))
    (tmp_path / "f.tsv").write_text("field_code\tfield_description\turl\n700\tB \"x\n700\tA | b\tNA\n", "utf-8")
    (tmp_path / "s.tsv").write_text("field_code\tsubfield_code\tsubfield_description\n008\t\tAll\n", "utf-8")
    f, s = dimensions.read_descriptions(spark, f"file://{tmp_path}/f.tsv"), dimensions.read_descriptions(spark, f"file://{tmp_path}/s.tsv", dimensions.SUBFIELDS)
    got = {r.field_code: r for r in composition.field_overview(d, f).collect()}
    assert got["700"].field_description == "A | b" and got["700"].url is None and got["700"].field_link == "700" and got["008"].field_description is None
    assert composition.repeated_descriptions(f, ["field_code"]).first().dropped == 1
    assert {r.field_code: r.subfield_description for r in composition.subfield_overview(d, f, s).collect()} == {"008": "All", "700": None}
    assert dimensions.read_descriptions(spark, None).count() == 0
    report = composition.composition(d, spark.createDataFrame([], dimensions.LANGUAGES))
    assert report["fields"].count() == 2 and report["codes"].first().n_subfields == 2


def test_scalars(spark):
    x = F.col("x")
    assert [one(spark, S.size_text("x"), v, "long") for v in (999, 1000, 1_500_000, 2_000_000_000, 3_400_000_000_000)] == ["999 B", "1 KB", "1.5 MB", "2 GB", "3.4 TB"]
    assert one(spark, S.group_text(x), "NA|008: a|b") == "008: a|b" and one(spark, S.group_url(x), "u|008: a|b") == "u"
    assert one(spark, S.http_date(x), "Tue, 15 Nov 1994 08:12:31 GMT") == "1994-11-15" and one(spark, S.http_date(x), "soon") is None
    assert one(spark, S.strip_prefix(x), "id\tx <a><b/></a>") == "<a><b/></a>"
    assert one(spark, S.report_title(x), "<title>\n Composition Analysis\nof the ".replace("\nof", " of") + "X dated D </title>") == "X dated D"
    assert one(spark, S.report_title(x), "<p>none</p>") == ""
    assert one(spark, S.percent_text(x), 0.1234, "double") == "12.34%" and one(spark, S.count_text(x), 1234567, "long") == "1,234,567"
    assert one(spark, S.subfield_anchor(F.lit("700"), x), "a") == '<a id="700a">a</a>'


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("v", F.xxhash64("id"))
    want = [r.id for r in df.orderBy("v").collect()]
    got = numbering.number_records(df.repartition(13), "v").orderBy("record_number")
    assert [r.id for r in got.collect()] == want and [r.record_number for r in got.collect()] == list(range(1, 1001))


def test_sampling(spark):
    d = table(spark, *((k, j, 1, "700", "a", "x") for k in range(500) for j in (1, 2)))
    some = selection.sample_records(d, 20, 1)
    assert 0 < some.count() < 400 and some.groupBy("record_number").count().filter("count <> 2").count() == 0
    assert selection.sample_records(d, 100, 1).count() == 1000 and selection.sample_records(d, 0, 1).count() == 0
    assert 100 < selection.sample_rows(d, 50, 3).count() < 900


def test_nested_documents(spark):
    text = '{"title": "X", "author": ["A", "B"], "imprint": [{"place": "Rome", "date": [1470, 1471], "printer": [{"name": "P", "viaf": 1}, {"name": "Q"}]}], "note": "[1470]", "empty": [], "flag": true}'
    df = spark.createDataFrame([("i1", text), ("i2", "{}"), ("i3", '{"a": [{}], "b": "{x"}')], "id string, json string")
    got = rows(nested.flatten_documents(df, "id", "json"), "record_number", "field_number", "subfield_number")
    assert got[:11] == [
        (1, 1, 1, "id", "", "i1"),
        (1, 2, 1, "title", "", "X"),
        (1, 3, 1, "author", "", "A"),
        (1, 4, 1, "author", "", "B"),
        (1, 5, 1, "imprint", "place", "Rome"),
        (1, 5, 2, "imprint", "date", "1470"),
        (1, 5, 3, "imprint", "date", "1471"),
        (1, 5, 4, "imprint", "printer_name", "P"),
        (1, 5, 5, "imprint", "printer_viaf", "1"),
        (1, 6, 1, "imprint", "printer_name", "Q"),
        (1, 8, 1, "note", "", "[1470]"),
    ]
    assert got[11:] == [(1, 9, 1, "flag", "", "true"), (2, 1, 1, "id", "", "i2"), (3, 1, 1, "id", "", "i3"), (3, 3, 1, "b", "", "{x")]


MARC = """<m:collection xmlns:m="urn:m"><m:record><m:leader>00000</m:leader><m:controlfield tag="001">b</m:controlfield><m:controlfield tag="008"> x </m:controlfield>
<m:datafield tag="700" ind1=" " ind2="1"><m:subfield code="a"> A &amp; B </m:subfield></m:datafield></m:record><m:record><m:leader>1</m:leader><m:controlfield tag="001">a</m:controlfield></m:record></m:collection>"""


def test_marcxml(spark, tmp_path):
    import gzip

    (tmp_path / "x.xml").write_text(MARC, "utf-8")
    with gzip.open(tmp_path / "y.xml.gz", "wt") as f:
        f.write(MARC.replace(">b<", ">c<").replace("m:", "").replace("xmlns:m", "xmlns"))
    got = rows(records.flatten_records(records.read_marcxml(spark, f"file://{tmp_path}/*.xml*")), "record_number", "field_number", "subfield_number")
    assert [r[5] for r in got if r[3] == "001"] == ["a", "b", "a", "c"]
    assert got[2:6] == [(2, 1, 1, "LDR", "", "00000"), (2, 2, 1, "001", "", "b"), (2, 3, 1, "008", "", " x "), (2, 4, 1, "700", "a", " A & B ")]
    marked = records.flatten_records(records.read_marcxml(spark, f"file://{tmp_path}/x.xml", indicators=True))
    assert [tuple(r)[4:] for r in marked.filter("field_code = '700'").orderBy("subfield_number").collect()] == [("ind1", " "), ("ind2", "1"), ("a", " A & B ")]
    assert records.broken_records(spark, f"file://{tmp_path}/x.xml").first().records == 2


def test_iso2709_and_pica(spark, tmp_path):
    one_, two = "0" * 24 + "001000000000" + "700000000000" + "\x1e", "0" * 24 + "001000000000\x1e"
    (tmp_path / "x.marc").write_bytes((one_ + "k1\x1e1 \x1faÄ\nb\x1fec\x1e\x1d" + two + "k2\x1e\x1d").encode())
    got = rows(records.flatten_records(records.read_iso2709(spark, f"file://{tmp_path}/x.marc")), "record_number", "field_number", "subfield_number")
    assert [r[2:] for r in got] == [(1, "LDR", "", "0" * 24), (1, "001", "", "k1"), (1, "700", "a", "Ä\nb"), (2, "700", "e", "c"), (1, "LDR", "", "0" * 24), (1, "001", "", "k2")]
    (tmp_path / "p.xml").write_text('<collection><record><datafield tag="003@"><subfield code="0">1</subfield></datafield><datafield tag="028C" occurrence="01"><subfield code="a"> x</subfield></datafield></record></collection>', "utf-8")
    pica = rows(records.flatten_records(records.read_picaxml(spark, f"file://{tmp_path}/p.xml")), "field_number")
    assert [r[3:] for r in pica] == [("003@", "0", "1"), ("028C/01", "a", " x")]


def test_every_dataset_is_read(spark, tmp_path):
    assert {d.format for d in DATASETS} == set(catalogues.READERS)
    (tmp_path / "a.jsonl").write_text('{"_id": "i2", "data": {"t": "x", "l": ["y", {"k": [1, 2], "m": "[z]"}]}}\n\n{"_id": "i1", "data": {"t": "é"}}\n', "utf-8")
    istc = next(d for d in DATASETS if d.dataset == "istc")
    got = rows(catalogues.ingest(spark, istc, f"file://{tmp_path}", f"file://{tmp_path}/out"), "record_number", "field_number", "subfield_number")
    assert got == [(1, 1, 1, "id", "", "i1"), (1, 2, 1, "t", "", "é"), (2, 1, 1, "id", "", "i2"), (2, 2, 1, "t", "", "x"), (2, 3, 1, "l", "", "y"), (2, 4, 1, "l", "k", "1"), (2, 4, 2, "l", "k", "2"), (2, 4, 3, "l", "m", "[z]")]


def test_harvest(spark):
    df = spark.createDataFrame([(("deleted", "1", "2024-01-01", "s"), None), ((None, "2", "2024-01-31", "s"), None), ((None, "3", "2024-02-01", "t"), None)], "header struct<_status:string,identifier:string,datestamp:string,setSpec:string>, metadata struct<record:struct<leader:string>>")
    ids = lambda x: sorted(r.header.identifier for r in x.collect())
    assert ids(harvest.oai_records(df, full_record=True)) == ["2", "3"]
    assert ids(harvest.oai_window(df, "2024-01-01", "2024-01-31")) == ["1", "2"] and ids(harvest.oai_window(df, set_spec="t")) == ["3"] and len(ids(harvest.oai_window(df))) == 3
    assert harvest.oai_records(df).columns == ["record"]
    pages = spark.createDataFrame([("a", 1, "<numberOfRecords>101</numberOfRecords>"), ("a", 51, "numberOfRecords>101</"), ("b", 1, "numberOfRecords>0</"), ("c", 1, "numberOfRecords>50</")], "harvest string, start int, content string")
    assert rows(harvest.harvest_audit(pages, 50), "harvest") == [("a", 101, 3, 2, 1, 101), ("b", 0, 0, 1, 0, None), ("c", 50, 1, 1, 0, None)]


def test_inventory(spark, tmp_path):
    cur = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "4")], "url string, etag string")
    old = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", "3"), ("e", "5")], "url string, etag string")
    assert rows(inventory.changed_sources(cur, old), "url") == [("b", "changed"), ("c", "unknown"), ("d", "new"), ("e", "removed")]
    df = spark.range(100)
    assert inventory.fingerprint(df).first() == inventory.fingerprint(df.repartition(5)).first() != inventory.fingerprint(df.filter("id < 99")).first()
    dates = spark.createDataFrame([(" 2024-01-02\n",), ("2023-12-31",)], "value string")
    assert inventory.dataset_date(dates).first().date == "2024-01-02"
    assert inventory.dataset_date(dates.filter("false"), fixed="2020-09").first().date == "2020-09"


def test_split_files(spark, tmp_path):
    d = table(spark, (1, 1, 1, "001", "", "a"), (2, 1, 1, "001", "", "b"))
    for name, k in (("x", 1), ("x_2", 2), ("xy", 1)):
        attributes.write_attributes(d.filter(F.col("record_number") == k), f"file://{tmp_path}/{name}.parquet")
    assert attributes.read_attributes(spark, f"file://{tmp_path}/x.parquet").count() == 2
    assert len(DATASETS) == 13 and registry(spark).count() == 13


def test_field_filter_reaches_the_scan(spark, tmp_path):
    attributes.write_attributes(table(spark, (1, 1, 1, "001", "", "a")), f"file://{tmp_path}/z.parquet")
    d = selection.select_field(attributes.read_attributes(spark, f"file://{tmp_path}/z.parquet"), "001").select("record_number")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(field_code,001)" in plan and "value" not in plan.split("ReadSchema")[1]


def test_datasets_together(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(MARC.replace(" x ", "850101s1650" + " " * 24 + "eng "), "utf-8")
    (tmp_path / "in" / "a.marc").write_bytes(("0" * 24 + "001000000000\x1ek1\x1e\x1d").encode())
    by = {d.dataset: d for d in DATASETS}
    catalogues.ingest(spark, by["ptnb"], f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    catalogues.ingest(spark, by["plnb"], f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    d = catalogues.read_datasets(spark, f"file://{tmp_path}/out", ["ptnb", "plnb"])
    assert {(r.dataset, r.n_records) for r in usage.dataset_totals(d, ["dataset"]).collect()} == {("ptnb", 2), ("plnb", 1)}
    assert rows(catalogues.years_by_dataset(d, registry(spark))) == [("ptnb", 1650, 1)]
    assert rows(catalogues.years_by_dataset(d, registry(spark).withColumn("max_year", F.lit(1600)))) == []


def test_prefixed_lines(spark):
    lines = spark.createDataFrame([("id\t<record><controlfield tag=\"001\">a<!-- < --></controlfield></record>",), ("no record",), ("x < y <record/>",)], "value string")
    got = rows(records.flatten_records(records.read_prefixed(lines)), "record_number")
    assert [r[3:] for r in got] == [("001", "", "a")]


def test_streams(spark, tmp_path):
    from fondscope.streaming import ingest

    attributes.write_attributes(table(spark, (1, 1, 1, "700", "a", "x"), (2, 1, 1, "700", "a", "y")), f"file://{tmp_path}/in")
    counts = ingest.usage_stream(ingest.attribute_stream(spark, f"file://{tmp_path}/in"))
    counts.writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("running")) == [("700", "a", 2)]
    twice = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("b", None, 3)], "record_id string, datestamp string, v int")
    assert sorted(r.v for r in ingest.newest_versions(twice).collect()) == [2, 3]


def test_composition_has_files(spark, tmp_path):
    d = attributes.write_attributes(table(spark, (1, 1, 1, "700", "a", "x")), f"file://{tmp_path}/d.parquet")
    report = composition.composition(d, spark.createDataFrame([], dimensions.LANGUAGES), path=f"file://{tmp_path}/d.parquet/*.parquet")
    assert report["files"].count() >= 1 and report["files"].columns == ["file", "bytes", "size"]
