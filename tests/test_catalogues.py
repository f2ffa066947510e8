"""Records by their directories and places, harvests and their merges, versions of files, reports of many datasets, layouts of tables."""

import hashlib
import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from fondscope.operators import numbering, selection, temporal, usage
from fondscope.plans import catalogues, composition
from fondscope.schema import ATTRIBUTE_SCHEMA, DATASETS
from fondscope.sources import attributes, digests, harvest, inventory, merge, records


def table(spark, *data):
    return spark.createDataFrame(list(data), ATTRIBUTE_SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def scanned(df):
    """Rows that come out of the scan, and files that it read, once `df` has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    metrics = leaves.apply(0).metrics()
    return metrics.apply("numOutputRows").value(), metrics.apply("numFiles").value()


# Binary MARC


def marc(fields, stored=None, leader="nam a22", widths="4500", base=None):
    """A record of fields (tag, body), stored in another order than the directory's."""
    n, s, extra = int(widths[0]), int(widths[1]), int(widths[2])
    order = list(range(len(fields))) if stored is None else stored
    starts, data = {}, b""
    for k in order:
        starts[k] = len(data)
        data += fields[k][1] + b"\x1e"
    entries = b"".join(tag + str(len(body) + 1).zfill(n).encode() + str(starts[k]).zfill(s).encode() + b"x" * extra for k, (tag, body) in enumerate(fields))
    at = 24 + len(entries) + 1
    head = str(at + len(data) + 1).zfill(5) + leader + (str(at).zfill(5) if base is None else base) + " i " + widths
    return head.encode() + entries + b"\x1e" + data + b"\x1d"


def test_directory_decides(spark, tmp_path):
    plain = [(b"001", b"7"), (b"245", "10\x1faÉtude – 日本\x1fb".encode()), (b"500", b"  \x1faone"), (b"500", "  \x1fatwo🜁".encode())]
    shown = [("LDR", [("", None)]), ("001", [("", "7")]), ("245", [("a", "Étude – 日本"), ("b", "")]), ("500", [("a", "one")]), ("500", [("a", "two🜁")])]
    variants = [marc(plain), marc(plain, [3, 1, 0, 2]), b"\r\n" + marc(plain, [2, 3, 1, 0], widths="3620"), marc(plain, base="00000"), marc(plain, base="     "), marc(plain, base="99999")]
    (tmp_path / "a.marc").write_bytes(b"".join(variants))
    for r in records.read_iso2709(spark, str(tmp_path / "a.marc")).collect():
        got = [(f.code, [(s.code, s.value) for s in f.subfields]) for f in r.fields]
        assert r.record_id == "7" and len(got[0][1][0][1]) == 24
        assert got[1:] == shown[1:]
    odd = [marc([(b"001", b"8"), (b"245", b"10\x1fa\xff\xfe\x1fbx")]), marc([]), b"short\x1d", b"\n"]
    (tmp_path / "b.marc").write_bytes(b"".join(odd))
    got = records.read_iso2709(spark, str(tmp_path / "b.marc")).collect()
    assert len(got) == 2 and [[s.value for s in f.subfields] for f in got[0].fields[1:]] == [["8"], ["��", "x"]] and [f.code for f in got[1].fields] == ["LDR"]


def test_directory_that_reaches_beyond_the_record(spark, tmp_path):
    """Its tags go with the stored fields in their order."""
    good = marc([(b"001", b"9"), (b"245", b"10\x1fax")])
    (tmp_path / "c.marc").write_bytes(good.replace(b"245000600002", b"245999900002"))
    (r,) = records.read_iso2709(spark, str(tmp_path / "c.marc")).collect()
    assert [(f.code, f.subfields[0].value) for f in r.fields[1:]] == [("001", "9"), ("245", "x")]


def test_numbers_by_place(spark, tmp_path):
    """Records are numbered by file and place, whatever their control numbers, in files of several ranges too."""
    rng = random.Random(1)
    want = []
    for name in ("a", "b", "c"):
        values = [f"{name}{k}-" + "x" * rng.randrange(60) for k in range(rng.randrange(40, 90))]
        (tmp_path / name).write_bytes(b"".join(marc([(b"245", b"  \x1fa" + v.encode())] if k % 3 else [(b"001", b"5"), (b"245", b"  \x1fa" + v.encode())]) for k, v in enumerate(values)))
        want += values
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        read = records.read_iso2709(spark, str(tmp_path / "*"))
        assert read.select("file", "block").distinct().count() > 6
        got = records.flatten_records(read, None).filter("field_code = '245'").select("record_number", "value").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got)) == [(k + 1, v) for k, v in enumerate(want)]
    assert numbering.number_by_place(spark.createDataFrame([], "file string, block long, x int")).columns == ["file", "block", "x", "record_number"]


def test_ingest_numbers_by_place(spark, tmp_path):
    """Control numbers may be missing, repeated or out of order in every format."""
    (tmp_path / "x.jsonl").write_text('{"_id": "b", "data": {"t": "1"}}\n\n{"_id": "a", "data": {"t": "2"}}\n')
    (tmp_path / "y.jsonl").write_text('{"_id": "b", "data": {"t": "3"}}\n')
    (tmp_path / "p.xml").write_text("".join(f'k\t<record><leader>{k}</leader><datafield tag="245"><subfield code="a">{k}</subfield></datafield></record>\n' for k in "291"))
    of = {x.dataset: x for x in DATASETS}
    made = catalogues.ingest(spark, of["istc"], str(tmp_path), str(tmp_path / "out"), by_place=True)
    assert rows(made.filter("field_code = 't'").select("record_number", "value")) == [(1, "1"), (2, "2"), (3, "3")]
    made = catalogues.ingest(spark, of["viaf"]._replace(inputs="p.xml"), str(tmp_path), str(tmp_path / "out"), by_place=True)
    assert rows(made.filter("field_code = '245'").select("record_number", "value")) == [(1, "2"), (2, "9"), (3, "1")]


def test_zstandard_files(spark, tmp_path):
    xml = '<collection xmlns="urn:x"><record><leader>L</leader><controlfield tag="001">1</controlfield></record><record><leader>M</leader><controlfield tag="001">2</controlfield></record></collection>'
    (tmp_path / "f.mrcx.zst").write_bytes(zstandard.compress(xml.encode()))
    got = records.flatten_records(records.read_marcxml(spark, str(tmp_path / "*.mrcx.zst")))
    assert rows(got.select("record_number", "field_code", "value")) == [(1, "001", "1"), (1, "LDR", "L"), (2, "001", "2"), (2, "LDR", "M")]


# Harvests


def test_reconciled(spark):
    """Ranges against positions counted one by one, over stretches of any size."""
    rng = random.Random(4)
    pages, totals = [], [("a", 95), ("b", 10), ("c", 0), ("d", 40)]
    for name, total in totals[:2]:
        pages += [(name, rng.randrange(1, total + 8), rng.randrange(0, 25)) for _ in range(7)]
    pages += [("c", 1, 3), ("d", 1, 20), ("d", 21, 20), (None, 1, 5)]
    want = []
    for name, total in totals:
        count = [sum(h == name and s <= x < s + n for h, s, n in pages) for x in range(140)]
        kinds = ["missing" if 1 <= x <= total and not c else "undeclared" if x > total and c else "doubled" if c > 1 else None for x, c in enumerate(count)]
        first = None
        for x in range(140):
            if kinds[x] != (kinds[x - 1] if x else None):
                if x and kinds[x - 1]:
                    want.append((name, kinds[x - 1], first, x - 1, x - first))
                first = x
    p, d = spark.createDataFrame(pages, "harvest string, start long, records long"), spark.createDataFrame(totals, "harvest string, total long")
    for span in (1, 7, 1000):
        assert rows(harvest.reconciled(p, d, span)) == sorted(want, key=repr)
    page = spark.createDataFrame([("<a><zs:record><recordData/></zs:record><record x='1'/><records/></a>",)], "content string")
    assert page.select(harvest.page_records().alias("n")).first().n == 2


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merges(spark, tmp_path, monkeypatch):
    schema, path = "record_id string, datestamp string, status string, n int", str(tmp_path / "t")
    df = lambda *data: spark.createDataFrame(list(data), schema)
    with pytest.raises(FileNotFoundError):
        merge.read_table(spark, path)
    merge.create_table(df(*((str(k), "2000", None, k) for k in range(40)), ("1", "1999", None, -1)), path, buckets=6)
    before = files_of(path)
    window = df(("1", "2001", None, 100), ("2", "2001", "deleted", 0), ("new", "2001", None, 7), ("3", "1990", None, -3), ("1", "2000", None, -4))
    touched = merge.merge_window(window, path)
    assert 0 < len(touched) < 6
    want = sorted([(str(k), k) for k in range(40) if k not in (1, 2)] + [("1", 100), ("new", 7)])
    live = lambda: sorted((r.record_id, r.n) for r in merge.read_table(spark, path).collect())
    assert live() == want and before <= files_of(path)
    used = {r.f for r in merge.read_table(spark, path).select(F.input_file_name().alias("f")).distinct().collect()}
    assert {os.path.basename(f) for f in used} & {os.path.basename(f) for f in before}  # untouched buckets keep their files
    merge.merge_window(window, path)
    assert live() == want
    merge.merge_window(df(("2", "2000", None, 2)), path)  # older than its deletion
    assert live() == want and merge.read_table(spark, path, deleted=True).count() == len(want) + 1
    assert merge.merge_window(df(), path) == set()
    assert merge.vacuum(spark, path, keep=1) > 0 and live() == want and not before <= files_of(path)
    assert merge.vacuum(spark, path) == 0 and merge.merge_window(window, path) and live() == want
    version, content = merge.manifest(spark, path)
    with pytest.raises(RuntimeError):
        merge._publish(spark, path, version, content)  # as another merge has done
    assert live() == want


# Versions


def plain_digest(data):
    lines = data.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    value = [0] * digests.RESIDUES
    for line in lines:
        m = hashlib.md5(line).digest()
        value = [(v * r + int.from_bytes(m[4 * k : 4 * k + 4], "big")) % digests.P for k, (v, r) in enumerate(zip(value, digests.PLACES, strict=True))]
    return len(lines), sum(len(x) + 1 for x in lines), "".join(f"{v:08x}" for v in value)


def test_file_versions_do_not_depend_on_ranges(spark, tmp_path):
    rng = random.Random(6)
    data = {"a.bin": rng.randbytes(60_000), "b.txt": b"one\r\ntwo\n\nthree", "c.txt": b"\n" * 50, "d.txt": b"", "e.txt": b"no end"}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    want = {name: (len(x), *plain_digest(x)) for name, x in data.items() if x}
    for size in ("128m", "5000b", "301b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            got = {os.path.basename(r.file): (r.size, r.lines, r.bytes, r.digest) for r in digests.content_fingerprint(spark, str(tmp_path)).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want
    (tmp_path / "b.txt").write_bytes(b"two\none\r\n\nthree")
    changed = {os.path.basename(r.file): r.digest for r in digests.content_fingerprint(spark, str(tmp_path)).collect()}
    assert {k for k in changed if changed[k] != want[k][3]} == {"b.txt"}


def test_fingerprints_are_put_together(spark):
    d = spark.createDataFrame([(k % 3, str(k), None if k % 4 else "x") for k in range(30)], "part int, a string, b string")
    old, new = d.filter("a < '2'"), d.filter("a >= '2'")
    assert rows(inventory.combined_fingerprints(inventory.fingerprint(old), inventory.fingerprint(new))) == rows(inventory.fingerprint(d))
    by = ["part"]
    assert rows(inventory.combined_fingerprints(inventory.fingerprint(old, by), inventory.fingerprint(new, by), by=by)) == rows(inventory.fingerprint(d, by))


# Usage, by dataset and for large values


def test_by_keeps_datasets_apart(spark):
    rows_ = [("a", 1, "008", "", "850101s1999"), ("a", 2, "700", "a", "x"), ("b", 1, "700", "a", "x"), ("b", 1, "700", "b", "y"), ("c", 1, "011@", "a", "1700"), ("c", None, "700", None, "z")]
    d = spark.createDataFrame([(s, n, 1, 1, f, c, v) for s, n, f, c, v in rows_], "dataset string, record_number long, field_number int, subfield_number int, field_code string, subfield_code string, value string")
    by = ["dataset"]
    assert rows(temporal.records_without_year(d, by)) == [("a", 1), ("b", 1), ("c", 1)]
    assert rows(temporal.records_without(d, temporal.record_years(d, by), by)) == [("a", 2), ("b", 1)] or rows(temporal.records_without(d, temporal.record_years(d, by), by)) == [("a", 2), ("b", 1), ("c", None)]
    assert rows(usage.code_counts(d, by)) == [("a", 2, 2), ("b", 1, 2), ("c", 2, 2)]
    levels = usage.usage_levels(d, by)
    assert rows(usage.codes_of(levels, by)) == rows(usage.code_counts(d, by)) and rows(usage.totals_of(levels, by)) == rows(usage.dataset_totals(d, by))
    assert rows(usage.subfield_usage(d, by=by).select("dataset", "field_code", "subfield_code", "n", "dist_vals"))[-1] == ("c", "700", None, 1, 1)
    empty = d.filter("false")
    assert rows(usage.totals_of(usage.usage_levels(empty))) == [(0, 0)] and usage.usage_levels(empty, by).count() == 0 and rows(temporal.records_without_year(empty)) == [(0,)]


def test_reports_by_the_registry(spark, tmp_path):
    of = {x.dataset: x for x in DATASETS}
    for k, name in enumerate(("cnb", "hpb", "estc")):
        attributes.write_attributes(table(spark, (1, 1, 1, "001", "", str(k)), (2, 1, 1, "008", "", f"850101s15{k}0"), (2, 2, 1, "700", "a", "x")), f"{tmp_path}/{name}.parquet")
    for name in ("marc", "pica"):
        (tmp_path / f"{name}_fields.tsv").write_text(f"field_code\tfield_description\turl\n700\tof {name}\tNA\n")
        (tmp_path / f"{name}_subfields.tsv").write_text("field_code\tsubfield_code\tsubfield_description\n")
    (tmp_path / "in/cnb").mkdir(parents=True)
    (tmp_path / "in/cnb/x.xml.gz.last_modified").write_text(" 2024-03-01\n")
    (tmp_path / "in/cnb/y.xml.gz.last_modified").write_text("2024-02-01")
    made = catalogues.report(spark, str(tmp_path), str(tmp_path), spark.createDataFrame([], "language_code string, language string"), [of[k] for k in ("cnb", "hpb", "estc")], f"{tmp_path}/in")
    assert rows(made["datasets"].select("dataset", "date")) == [("cnb", "2024-03-01"), ("estc", "2020-09"), ("hpb", "2025-03")]
    assert rows(made["years"]) == [("cnb", 1500, 1), ("estc", 1520, 1), ("hpb", 1510, 1)] and rows(made["without_year"]) == [("cnb", 1), ("estc", 1), ("hpb", 1)]
    assert rows(made["fields"].filter("field_code = '700'").select("dataset", "field_description", "records", "r_p")) == [("cnb", "of marc", 1, 0.5), ("estc", "of marc", 1, 0.5), ("hpb", "of pica", 1, 0.5)]
    assert rows(made["totals"]) == [("cnb", 2, 3), ("estc", 2, 3), ("hpb", 2, 3)] and rows(made["codes"]) == [("cnb", 3, 3), ("estc", 3, 3), ("hpb", 3, 3)]
    assert {(r.dataset, r.file[:8]) for r in made["files"].collect()} == {(k, "part-000") for k in ("cnb", "hpb", "estc")} and made["files"].filter("bytes > 0").count() >= 3
    files = catalogues.dataset_dates(spark, f"{tmp_path}/in", [of["vd17"], of["plnb"]])
    assert rows(files) == [("plnb", ""), ("vd17", "")]
    (tmp_path / "in/vd17").mkdir()
    (tmp_path / "in/vd17/1.xml.gz").write_bytes(b"x")
    os.utime(tmp_path / "in/vd17/1.xml.gz", (1_700_000_000, 1_700_000_000))
    assert rows(catalogues.dataset_dates(spark, f"{tmp_path}/in", [of["vd17"]])) == [("vd17", "2023-11-14")]


def test_exact_quantiles(spark):
    rng = random.Random(8)
    inf = float("inf")
    for values in ([rng.gauss(0, 1) for _ in range(3000)], [rng.choice([1.0, 2.0, 2.5]) for _ in range(2000)], [10.0 ** rng.randint(-300, 300) * rng.random() for _ in range(2000)], [-inf, *range(30), inf], [4.0], [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324] * 9):
        data = sorted(map(float, values))
        for most in (10, 1 << 20):
            got = usage.order_statistics(spark.createDataFrame([(float(v),) for v in values], "x double"), [*range(0, len(data), 397), len(data) - 1], most)
            assert got == {k: data[k] for k in [*range(0, len(data), 397), len(data) - 1]}
    d = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "x double")
    assert usage.quantiles(d, "x", [0, 0.25, 0.5, 1]) == [1.0, 1.5, 2.0, 4.0] and usage.quantiles(d.filter("x is null"), "x", [0.5]) == [None]
    assert [r["class"] for r in usage.quantile_class(d.filter("x < 9"), "x", 2).orderBy("x").collect()] == [1, 2, 2]


# Plans and layouts


def test_usage_takes_one_exchange_of_rows_and_one_scan(spark, tmp_path):
    d = attributes.write_attributes(table(spark, *((k, 1, 1, "700", "a", str(k % 5)) for k in range(50))), f"{tmp_path}/x.parquet")
    plan = final_plan(usage.field_usage(d))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning(record_number") == 1
    plan = final_plan(composition.subfield_overview(d))
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning(record_number") == 1 and plan.count("ReusedExchange") == 1
    assert sum("hashpartitioning(field_code" in x and "value#" in x and "Reused" not in x for x in plan.splitlines()) <= 2


def test_buckets_need_no_exchange_of_rows(spark, tmp_path):
    data = [(k % 40, k, 1, "700" if k % 3 else "001", "a", str(k % 5)) for k in range(200)]
    d = attributes.write_bucketed(table(spark, *data), "bucketed_rows", str(tmp_path / "b"), 4)
    got = usage.field_usage(d, dealt=True)
    assert "hashpartitioning(record_number" not in final_plan(got)
    assert rows(got) == rows(usage.field_usage(table(spark, *data)))
    assert "hashpartitioning(record_number" not in final_plan(temporal.records_without_year(d))


def test_look_ups_skip_rows(spark, tmp_path):
    rng = random.Random(2)
    data = [(k, 1, 1, "700", "a", hashlib.md5(str(rng.randrange(9000)).encode()).hexdigest()) for k in range(20000)]
    d = attributes.write_by_value(table(spark, *data), str(tmp_path / "v"), row_group_bytes=64 << 10)
    value = data[0][5]
    found = d.filter((F.col("field_code") == "700") & (F.col("value") == value))
    n, _ = scanned(found)
    assert found.count() == sum(r[5] == value for r in data) and n < 0.3 * len(data) and rows(d) == sorted(data, key=repr)


def test_block_samples_read_what_they_draw(spark, tmp_path):
    data = [(k, 1, 1, "700", "a", "x") for k in range(4000)]
    attributes.write_attributes(table(spark, *data).repartition(4), str(tmp_path / "s"), rows_per_file=50)
    d = spark.read.parquet(str(tmp_path / "s"))
    files = len(files_of(tmp_path / "s"))
    some = selection.sample_blocks(d, 25, 1)
    n, read = scanned(some)
    assert 0 < read < 0.5 * files and n == some.count() and rows(some) == rows(selection.sample_blocks(d, 25, 1))
    totals = [selection.sample_blocks(d, 25, seed).agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("n")).first().n for seed in range(12)]
    assert abs(sum(totals) / 12 - 4000) < 800 and selection.sample_blocks(d, 100, 1).agg(F.sum("weight").alias("n")).first().n == 4000
