"""Readers, writers and layers."""

import csv as text_csv

import io
import random
import re
import time

import pytest
from pyspark.sql import Observation, functions as F, types as T

from riskloom import fixed_values as V
from riskloom.operators.staging import stage_loans
from riskloom.sources import csv, layers, records, storage


def loan(i, **changes):
    row = {name: "1" for name in V.ACCEPTED_COLUMNS}
    row |= {"id": str(i), "term": " 36 months", "int_rate": "13.56%", "grade": "B", "sub_grade": "B2",
            "emp_length": "10+ years", "home_ownership": "RENT", "issue_d": "Dec-2015",
            "verification_status": "Verified", "loan_status": "Fully Paid", "purpose": "car",
            "title": 'a "quoted", title', "addr_state": "CA", "revol_util": "", "last_pymnt_d": "Jan-2017",
            "initial_list_status": "w", "application_type": "Individual", "annual_inc": "50000"}
    return row | changes


@pytest.fixture
def accepted_file(tmp_path):
    """Known columns in another order, two unknown ones, and rows to drop."""
    header = ["member", *reversed(V.ACCEPTED_COLUMNS), "url"]
    path = tmp_path / "accepted.csv"
    rows = [loan(1), loan(2, loan_status="Charged Off"), loan(3, loan_amnt="not a number"),
            loan(4, loan_status=""), loan(5, open_acc="seven"),
            {"id": "Total amount funded in policy code 1: 460296150"}]
    with open(path, "w", newline="") as out:
        writer = text_csv.DictWriter(out, header, restval="")
        writer.writeheader()
        writer.writerows(rows)
        out.write("x,too,few,fields\n")
        out.write(",".join(["9"] * (len(header) + 3)) + "\n")
    return str(path)


def test_read_accepted_drops_bad_rows(spark, accepted_file):
    loans = csv.read_accepted(spark, accepted_file)
    assert loans.columns == V.ACCEPTED_COLUMNS
    # The broken open_acc counts although only other columns are asked for.
    assert sorted(r.id for r in loans.select("id", "title").collect()) == [1, 2]
    first = loans.where("id = 1").first()
    assert (first.term, first.title, first.revol_util, first.loan_amnt) == (
        " 36 months", 'a "quoted", title', None, 1.0)


def test_read_accepted_then_stage(spark, accepted_file):
    staged = stage_loans(csv.read_accepted(spark, accepted_file)).orderBy("id").collect()
    assert [(r.term_months, r.is_bad, r.vintage_year, r.vintage_quarter, r.emp_length_yrs) for r in staged] == [
        (36, 0, 2015, 4, 10), (36, 1, 2015, 4, 10)]
    assert len(staged[0]) == 35


KNOWN = {"id": T.LongType(), "title": T.StringType(), "amount": T.DoubleType()}


def written(path, rows, end="\n", header=("id", "title", "amount")):
    out = io.StringIO()
    text_csv.writer(out, lineterminator=end).writerows([header, *rows])
    path.write_bytes(out.getvalue().encode())


def random_rows(seed, n):
    rng = random.Random(seed)
    pieces = ["plain", 'a "quoted"', "x,y", "line\nbreak", "\n", '"', "é", '",\n"', "", " ", '""']
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) or "-", float(i)) for i in range(n)]


@pytest.fixture
def small_parts(spark):
    """Files are cut into parts of 200 bytes, so that records cross from one to the next."""
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def read_back(spark, path):
    seen = Observation()
    rows = csv._read_known(spark, str(path), KNOWN, seen).collect()
    return [tuple(r) for r in rows], seen.get


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_line_breaks(spark, tmp_path, small_parts, seed, end):
    """Records that cross parts come out as the csv module reads them, files without breaks untouched."""
    rows = random_rows(seed, 120)
    written(tmp_path / "a.csv", rows, end)
    written(tmp_path / "b file.csv", [(1000 + i, 'plain, "b"', 1.0) for i in range(30)], end)
    got, counts = read_back(spark, tmp_path)
    text = (tmp_path / "a.csv").read_bytes().decode()
    want = [(int(a), b.replace("\r\n", "\n"), float(c)) for a, b, c in list(text_csv.reader(io.StringIO(text, newline="")))[1:]]
    trimmed = lambda rs: sorted((a, b.strip(), c) for a, b, c in rs)
    assert trimmed(r for r in got if r[0] < 1000) == trimmed(want)
    assert sum(r[0] >= 1000 for r in got) == 30
    assert counts == {"n_records": 150, "n_cut": 0, "n_ill_typed": 0}


def test_only_files_with_open_quotes_are_assembled(spark, tmp_path):
    written(tmp_path / "closed.csv", [(1, 'a "b", c', 1.0), (2, ',"', 2.0)])
    written(tmp_path / "open.csv", [(3, "a\nb", 1.0)])
    found = records.files_with_open_quotes(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in found] == ["open.csv"]


def test_malformed_records_are_counted_and_shown(spark, tmp_path):
    """In a file with breaks and in one without, rows that are cut or ill-typed are told from good ones."""
    for name, title in (("open.csv", '"two\nlines"'), ("closed.csv", '"one, line"')):
        (tmp_path / name).write_text(
            f"id,title,amount\n1,{title},1.5\n2,short\n3,long,1,2,3\n4,{title},many\n\n5,,2\n")
    got, counts = read_back(spark, tmp_path)
    assert sorted(got, key=str) == sorted([(1, "two\nlines", 1.5), (1, "one, line", 1.5)] + [(5, None, 2.0)] * 2, key=str)
    assert counts == {"n_records": 10, "n_cut": 4, "n_ill_typed": 2}
    shown = csv.malformed_records(spark, str(tmp_path), KNOWN).collect()
    assert sorted(map(tuple, shown)) == sorted(
        [("number of fields", "2,short"), ("number of fields", "3,long,1,2,3")] * 2
        + [("type", '4,"two\nlines",many'), ("type", '4,"one, line",many')])


def test_assembled_records_are_parsed_once(spark, tmp_path):
    """Conditions on many columns do not parse a record again for each."""
    (tmp_path / "a.csv").write_text('id,title,amount\n1,"two\nlines",1\nx,"two\nlines",2\n')
    shown = csv.malformed_records(spark, str(tmp_path), KNOWN)
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert [tuple(r) for r in shown.collect()] == [("type", 'x,"two\nlines",2')]


def test_stray_and_unclosed_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,title,amount\n1,5" pipe,1\n2,"a\nb",2\n3,"open,3\n4,rest,4\n')
    got, counts = read_back(spark, tmp_path)
    assert sorted(got) == [(1, '5" pipe', 1.0), (2, "a\nb", 2.0)]
    assert counts["n_cut"] == 1


def test_line_states():
    for line, outside, inside in [("a,b", False, True), ('a,"b', True, False), ('"a,b"', False, False),
                                  ('x",y', False, False), ('a""b', False, True), ('5" pipe,"x', True, True),
                                  ('"a"x,"b', True, True), ("", False, True), ('"', True, False), ('""', False, True)]:
        assert (records.ends_inside(line, False), records.ends_inside(line, True)) == (outside, inside), line


@pytest.mark.parametrize("title", ["plain", "with\nbreak"])
def test_headers_in_another_order_raise(spark, tmp_path, title):
    written(tmp_path / "a.csv", [(1, title, 1.0)])
    written(tmp_path / "b.csv", [(title, 2, 1.0)], header=("title", "id", "amount"))
    with pytest.raises(Exception, match="(?i)header"):
        read_back(spark, tmp_path)


def test_missing_column_is_reported(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("id,term\n1, 36 months\n")
    with pytest.raises(ValueError, match="loan_status"):
        csv.read_accepted(spark, str(path))


def test_read_rejected(spark, tmp_path):
    path = tmp_path / "rejected.csv"
    path.write_text(",".join(V.REJECTED_COLUMNS) + "\n"
                    "1000.0,2007-05-26,car,693.0,10%,481xx,NM,4 years,0.0\n"
                    ",2007-05-26,car,693.0,10%,481xx,NM,4 years,0.0\n"
                    "2000.0,2007-05-27,house,,10%,481xx,NM,4 years,0.0\n")
    rows = csv.read_rejected(spark, str(path)).orderBy("amount_requested").collect()
    assert [(r.amount_requested, r.risk_score, r.zip_code) for r in rows] == [
        (1000.0, 693.0, "481xx"), (2000.0, None, "481xx")]


def test_points_and_report_round_trip(spark, tmp_path):
    points = spark.createDataFrame([("grade_woe", -0.5, -28.85)],
                                   "feature string, coefficient double, points_per_unit_woe double")
    path = str(tmp_path / "points")
    csv.write_csv_report(points, path)
    assert [tuple(r) for r in csv.read_points(spark, path).collect()] == [("grade_woe", -28.85)]


def test_layers_by_name_and_path(spark, tmp_path):
    names = tuple(f"riskloom_test_{n}" for n in layers.LAYERS)
    try:
        for _ in range(2):
            layers.create_layers(spark, names)
        df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "oot").otherwise("train"))
        for target in (f"{names[0]}.loans", str(tmp_path / "loans")):
            for _ in range(2):   # the second write replaces the first
                assert layers.write_layer(df, target, "split").count() == 10
            part = layers.read_split(spark, target, "oot", ["id", "split", "id"])
            assert part.columns == ["id", "split"] and part.count() == 3
            assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().toString()
    finally:
        for name in names:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.mark.parametrize("kind", ["path", "table"])
@pytest.mark.parametrize("split", [None, "split"])
def test_failed_write_leaves_the_layer(spark, tmp_path, kind, split):
    """Readers find the old layer after a write that failed half-way, and versions expire."""
    name = "riskloom_versions_test"
    target = str(tmp_path / "loans") if kind == "path" else f"{name}.loans"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/db'")
    try:
        df = spark.range(100).withColumn("split", F.when(F.col("id") < 30, "007").otherwise("train"))
        layers.write_layer(df, target, split)
        reader = layers.read_layer(spark, target)
        broken = df.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("broken row")).cast("bigint"))
                               .otherwise(F.col("id") + 1000)).repartition(4)
        with pytest.raises(Exception, match="broken row"):
            layers.write_layer(broken, target, split)
        again = layers.read_layer(spark, target)
        assert again.where("split = '007'").agg(F.sum("id")).first()[0] == sum(range(30))
        # a layer may be computed from itself, and who reads the old one goes on
        for step in (1, 2, 3):
            made = layers.write_layer(layers.read_layer(spark, target).withColumn("id", F.col("id") + 1), target, split)
            assert made.agg(F.min("id")).first()[0] == step
            if step == 1:
                assert reader.agg(F.min("id")).first()[0] == 0
        assert made.columns == df.columns and made.dtypes == df.dtypes
        left = ([p for p in (tmp_path / "loans" / "_versions").iterdir()] if kind == "path"
                else [t for t in spark.catalog.listTables(name) if t.name != "loans"])
        assert len(left) == 2
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_plain_folders_are_layers_too(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "plain"))
    assert layers.read_layer(spark, str(tmp_path / "plain")).count() == 5


def test_samples(spark):
    df = spark.range(1000).withColumn("split", F.when(F.col("id") % 2 == 0, "oot").otherwise("train"))
    first = {r.id for r in layers.sample_split(df, 100, "oot").collect()}
    again = {r.id for r in layers.sample_split(df.repartition(7), 100, "oot").collect()}
    assert first == again and len(first) == 100 and all(i % 2 == 0 for i in first)
    assert 40 < layers.sample_fraction(df, 100, "oot").count() < 180
    assert layers.sample_split(df, 5000, "oot").count() == 500
    assert layers.sample_split(df, 0, "oot").count() == 0


def test_samples_take_the_least_digests(spark):
    """Also with repeated and missing keys, at every size."""
    rows = [(i // 3 if i % 10 else None, i) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, row int").withColumn("split", F.lit("oot"))
    order = df.withColumn("m", F.md5(F.col("id").cast("string"))).orderBy(F.asc_nulls_last("m"), "id").collect()
    for n in (1, 7, 123, 359, 361, 400):
        got = layers.sample_split(df, n, "oot").collect()
        assert sorted(str(r.id) for r in got) == sorted(str(r.id) for r in order[:n])


def test_broadcast_only_when_small(spark):
    df = spark.range(1000).withColumn("text", F.lit("x" * 100))
    assert storage.fits_broadcast(df)
    assert not storage.fits_broadcast(df, limit=50_000)
    assert "broadcast" not in storage.small_side(df, 50_000)._jdf.queryExecution().analyzed().toString()


def test_shared_dir_follows_the_session(spark):
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given is not None:
        assert storage.shared_dir(spark) == given
    assert storage.scratch_path(spark, "a") != storage.scratch_path(spark, "a")


def test_scratch_is_dropped_but_for_what_is_kept(spark, tmp_path):
    """Also from a scope inside another, and after an error."""
    def folders():
        root = storage.scratch_path(spark, "x").rsplit("/", 1)[0]
        system = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        return {s.getPath().getName() for s in system.listStatus(path)} if system.exists(path) else set()

    before = folders()
    with storage.scratch(spark) as keep:
        storage.materialize(spark.range(3))
        with storage.scratch(spark) as keep_inside:
            first = storage.materialize(spark.range(5))
            inside = keep_inside(first)
            storage.materialize(spark.range(7))
        assert inside is first and inside.count() == 5
        result = keep(inside.where("id > 1"))
        with pytest.raises(RuntimeError), storage.scratch(spark):
            storage.materialize(spark.range(9))
            raise RuntimeError
    assert result.count() == 3
    assert len(folders() - before) == 1


def test_materialize_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return set(re.findall(r"shuffle_\d+_\d+_\d+", found.mkString(" ")))

    before = files()
    rows = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.collect_list("id").alias("ids"))
    with storage.scratch(spark) as keep:
        made = keep(rows)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert made.count() == 1000 and rows.count() == 1000
    assert spark.conf.get(storage.SHUFFLE_CLEANUP) == "false"
