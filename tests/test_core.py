"""Core functions and operators on small fixtures: known values, brute force, nulls, empties, ties."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from amalgrid.functions import casing, cleaning, pairnames, rules, similarity, tfidf
from amalgrid.functions.text import title
from amalgrid.operators import graph, learning, pairs, tables
from amalgrid import cli
from amalgrid.sources import files, workbook
from amalgrid.streaming.ledger import Ledger, ledger_stream


def one(spark, column_of, *values):
    df = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], "i int, s string" if not isinstance(values[0], tuple) else "i int, s string, t string")
    return [r[0] for r in df.orderBy("i").select(column_of).collect()]


def test_types_and_names(spark):
    assert one(spark, cleaning.route_type("s"), "smith family trust", "city of perth", "bond 3.5% 20260801", "acme ltd", "university pension fund") == ["trust", "government", "security", "company", "trust"]
    assert one(spark, cleaning.display_name("s"), "the trustee for smith trust", "acme proprietary limited (nsw)") == ["smith trust", "acme pty ltd"]
    assert one(spark, cleaning.canonical_name("s"), "acme pty ltd", "o'neil inc") == ["Acme PTY LTD", "O'Neil INC"]
    assert one(spark, cleaning.match_key_strict("s"), "acme pty ltd") == ["acme"]
    assert one(spark, cleaning.match_key_aggressive("s"), "smith & jones group") == ["smith and jones"]
    assert one(spark, cleaning.normalize("s"), "  “Ａｃｍｅ”  –  Co.  ", None, "", "ﬁrm & ") == ['"acme" - co', "", "", "firm"]
    got = cleaning.sanitise(spark.createDataFrame([(1, None, "old"), (2, "ACME Ltd", "old")], "id int, record_name string, norm string")).orderBy("id").collect()
    assert [r.norm for r in got] == ["", "acme ltd"] and got[0].type_hint == "company"


def test_casing_and_rules(spark):
    assert one(spark, title("s"), "o'neil 3m 2nd", "élan ﬁne") == ["O'Neil 3M 2Nd", "élan ﬁne".title()]
    assert one(spark, casing.cased_suffixes("s"), "Let It Be", "hp inc", "IBM AUSTRALIA PTY LTD", None) == ["Let IT Be", "HP Inc", "IBM AUSTRALIA Pty Ltd", None]
    assert one(spark, casing.smart_title("s"), "bank of the west pty ltd", "the ibm way") == ["Bank of the West PTY LTD", "The IBM Way"]
    assert one(spark, rules.apply_rules("s"), "acme p/l", "foo & co ltd", "x corp | y", "zz foo 12/3/2020 (bar)", "a limited liability co") == ["acme pty ltd", "foo and company ltd", "x corporation", "foo", "a limited liability company"]
    assert len(rules.RULES) == 32 and len(rules.LEGACY_RULES) == 29
    assert one(spark, rules.clean_name("s"), "SMITH & SONS PTY. LTD.", None) == ["Smith And Sons Pty Ltd", ""]
    with pytest.raises(ValueError):
        rules.clean_frame(spark.range(1), "Name")


def test_pair_names(spark):
    assert one(spark, pairnames.company_name("s"), "Aust. Tech Pty Limited", None, "") == ["australia technology pty ltd", "", ""]
    assert one(spark, pairnames.core_name("s"), "Aust. Tech Pty Limited") == ["australia technology"]
    assert one(spark, pairnames.name_tokens("s"), None, "A-b") == [[], ["a", "b"]]


def test_similarities(spark):
    a, b = F.col("s"), F.col("t")
    values = [("kitten", "sitting"), ("a", "b"), ("", "abc"), ("ab", "ab"), ("ca", "abc")]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, s string, t string").orderBy("i")
    got = {name: [round(r[0], 6) for r in df.select(f(a, b)).collect()] for name, f in (("lev", similarity.levenshtein), ("jac", similarity.jaccard), ("ham", similarity.hamming), ("osa", similarity.damerau_levenshtein), ("full", similarity.damerau_levenshtein_full), ("tj", similarity.token_jaccard))}
    assert got["lev"][:4] == [round(1 - 3 / 7, 6), 0.0, 0.0, 1.0]
    assert got["jac"][:4] == [round(2 / 9, 6), 1.0, 0.0, 1.0] and got["ham"][0] == round(4 / 7, 6)
    assert got["osa"][4] == 0.0 and got["full"][4] == round(1 - 2 / 3, 6) and got["tj"][2:4] == [0.0, 1.0]
    assert similarity.phonetic_distance("nelson", "neilsen") == 2 and similarity.phonetic_distance("cat", "cat") == 0
    assert one(spark, similarity.change_kind("s", "t"), ("abc", "ABC"), ("abcdef", "abcdeg"), ("a", "abcd"), ("abcdefgh", "abc")) == ["no_change", "minor_edit", "major_expansion", "major_reduction"]
    made = similarity.add_features(spark.createDataFrame([(None, "x"), ("", "")], "company1 string, company2 string"))
    assert all(r[f] is not None for r in made.collect() for f in similarity.ALL_FEATURES)


NAMES = ["Acme Roofing Pty Ltd", "Acme Roofing Pty Ltd.", "ACME ROOFING PTY LTD", "Bolt & Co", "Bolt and Co", "Zeta", "Zeta Holdings", None, "", "Acme Roofing Pty Ltd"]


def test_tfidf_pairs_are_exact(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "idx long, company string")
    weights = {}
    for r in tfidf.tfidf(df.filter("company is not null").groupBy("company").agg(F.min("idx").alias("idx"))).collect():
        weights.setdefault(r.idx, {})[r.gram] = r.weight
    for t in (0.5, 0.9):
        want = {(i, j) for i, j in itertools.combinations(sorted(weights), 2) if sum(w * weights[j].get(g, 0) for g, w in weights[i].items()) > t + 1e-12}
        first = {n: i for i, n in reversed(list(enumerate(NAMES)))}
        got = {(r.idx1, r.idx2) for r in tfidf.similar_pairs(df, t).collect()}
        assert {p for p in got if p[0] in weights and p[1] in weights} == want and (first[NAMES[9]], 9) in got
    assert one(spark, tfidf.name_grams("s"), "AB") == [[" Ab", "Ab "]]
    assert tfidf.similar_pairs(df.limit(0)).count() == 0


EDGES = [(0, 1, 0.8), (1, 2, 0.75), (3, 4, 0.5)]


@pytest.fixture()
def small(spark):
    return spark.range(5).withColumnRenamed("id", "idx"), spark.createDataFrame(EDGES, "idx1 long, idx2 long, similarity double")


def as_dict(df):
    return {r.idx: r.cluster_id for r in df.collect()}


def test_clusters(spark, small):
    nodes, edges = small
    assert as_dict(graph.dbscan(nodes, edges)) == {0: 0, 1: 0, 2: 0, 3: -1, 4: -1}
    assert as_dict(graph.threshold_clusters(nodes, edges)) == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2}
    assert as_dict(graph.dbscan(nodes, edges, min_samples=3)) == {0: 0, 1: 0, 2: 0, 3: -1, 4: -1}
    m = graph.cluster_metrics(graph.dbscan(nodes, edges), edges).filter("cluster_id = 0").first()
    assert (m["size"], round(m.avg_similarity, 9), m.min_similarity, m.max_similarity) == (3, round(1.55 / 3, 9), 0.0, 0.8)
    assert as_dict(graph.agglomerative(nodes, edges, 0.3, linkage="single"))[2] == 0
    assert as_dict(graph.agglomerative(nodes, edges, 0.3))[2] != 0
    assert len(set(as_dict(graph.agglomerative(nodes, edges, n_clusters=2)).values())) == 2
    with pytest.raises(ValueError, match="beyond the limit"):
        graph.agglomerative(nodes, edges, n_clusters=2, largest=1)
    assert as_dict(graph.dbscan(nodes, edges.limit(0))) == dict.fromkeys(range(5), -1)
    names = spark.createDataFrame([(0, "a"), (1, "a x"), (2, "b"), (3, None), (4, "")], "idx long, company string")
    assert as_dict(graph.two_phase(names, edges.unionByName(spark.createDataFrame([(3, 4, 0.9)], edges.schema)))) == {0: 0, 1: 0, 2: -1, 3: 1, 4: 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_average_linkage_by_brute_force(spark, seed):
    r = random.Random(seed)
    n = 14
    s = {(i, j): round(r.random(), 3) for i, j in itertools.combinations(range(n), 2) if r.random() < 0.5}
    nodes, edges = spark.range(n).withColumnRenamed("id", "idx"), spark.createDataFrame([(*k, v) for k, v in s.items()], "idx1 long, idx2 long, similarity double")
    clusters = [{i} for i in range(n)]
    while len(clusters) > 1:
        d, a, b = min((sum(1 - s.get((min(i, j), max(i, j)), 0) for i in x for j in y) / len(x) / len(y), k, m) for (k, x), (m, y) in itertools.combinations(enumerate(clusters), 2))
        if not d < 0.6:
            break
        clusters[a] |= clusters.pop(b)
    # Within one task, and by rounds of all tasks.
    for largest in (1000, 3):
        got = as_dict(graph.agglomerative(nodes, edges, 0.6, largest=largest))
        assert {frozenset(c) for c in clusters} == {frozenset(i for i in got if got[i] == g) for g in set(got.values())}
    for linkage in ("single", "complete"):
        assert as_dict(graph.agglomerative(nodes, edges, 0.4, linkage=linkage, largest=1000)) == as_dict(graph.agglomerative(nodes, edges, 0.4, linkage=linkage, largest=3))
    near = [k for k, v in s.items() if v >= 0.8]
    roots = {r.idx: r.root for r in graph.components(spark.createDataFrame(near, "idx1 long, idx2 long")).collect()}
    for i, j in near:
        assert roots[i] == roots[j] <= min(i, j)


def test_table_operators(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, "c")], "i long, v string")
    assert [tuple(r) for r in tables.value_counts(df, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert {tuple(r) for r in tables.dense_ids(df, "v").collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert [(r.v, r.rank, round(r.cumulative_share, 2)) for r in tables.rank_frequency(df, "v").orderBy("rank").collect()] == [("b", 1, 0.5), ("a", 2, 0.75), ("c", 3, 1.0)]
    assert tables.profile(df.limit(0), "v").first().n_rows == 0
    h = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, None)], "x double")
    assert [tuple(r) for r in tables.histogram(h, "x", 2).collect()] == [(0, 1), (1, 2)]
    m = tables.binary_metrics(spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 0, 0.1)], "label int, prediction int, s double"), score="s").first()
    assert (m.tp, m.fp, m.fn, m.tn, m.precision, m.recall, m.roc_auc) == (1, 0, 1, 2, 1.0, 0.5, 0.875)
    assert tables.binary_metrics(spark.createDataFrame([], "label int, prediction int")).first().f1 == 0
    p = spark.createDataFrame([("A", "B", 0.9), ("C", "A", 0.8), ("B", "C", None)], "company1 string, company2 string, prediction_proba double")
    assert [tuple(r) for r in tables.similar_companies(p, "A", 5, 0.85).collect()] == [("B", 0.9)] and tables.similar_companies(p, "?").count() == 0
    assert [tuple(r) for r in tables.continued_ids(df, "v", df, "i").orderBy("id").collect()] == [("a", 6), ("b", 7), ("c", 8)]
    with pytest.raises(ValueError):
        pairs.block_pairs(df, method="sound")
    names = spark.createDataFrame([(0, "Alpha"), (1, "a b"), (2, "")], "idx long, company string")
    assert pairs.block_pairs(names).count() == 1 and pairs.all_pairs(names).count() == 3
    many = spark.range(60).select(F.col("id").alias("idx"), F.concat(F.when(F.col("id") % 3 == 0, "b").otherwise("A"), F.col("id").cast("string")).alias("company"))
    want = {(i, j) for i, j in itertools.combinations(range(60), 2) if (i % 3 == 0) == (j % 3 == 0)}
    for part in (5000, 7):
        got = [tuple(r) for r in pairs.block_pairs(many, part=part).collect()]
        assert set(got) == want and len(got) == len(want)
    scores = spark.createDataFrame([(x,) for x in (3.0, 1.0, 1.0, 2.5, 9.0, None, 4.0)], "x double")
    d = tables.describe(scores, "x").first()
    assert (d.n, d.lo, d.q1, d.q2, d.q3, d.hi) == (6, 1.0, 1.375, 2.75, 3.75, 9.0) and tables.describe(scores.limit(0), "x").first().n == 0
    assert one(spark, similarity.lower_token_overlap("s", "t"), ("A b", "a C"), ("", ""), ("x", "")) == [1 / 3, 1.0, 0.0]
    assert one(spark, tfidf.plain_trigrams("s"), "ABcd", "ab", None) == [["abc", "bcd"], [], []]
    assert one(spark, similarity.closer(F.length("s"), F.length("t")), ("a", "bb"), ("aa", "b"), ("a", "b")) == ["cleaned", "sanitised", "same"]
    assert casing.config_hash({"b": 1, "a": 2}) == casing.config_hash({"a": 2, "b": 1})


def test_block_pairs_are_many_tasks(spark):
    """A short list of names has many pairs: they are made by many tasks, in any parts, and each once."""
    ids = [(i, f"a{i}") for i in range(1700)] + [(i, f"b{i}") for i in range(1700, 2000)] + [(5, "a again"), (None, "a none")]
    df = spark.createDataFrame(ids, "idx long, company string").coalesce(1)
    want = sorted((*sorted((x[0], y[0])), x[1][0]) for x, y in itertools.combinations(ids[:-1], 2) if x[0] != y[0] and x[1][0] == y[1][0])
    for part in (5000, 600):
        made = pairs.block_pairs(df, part=part, keep_block=True)
        rows = made.withColumn("task", F.spark_partition_id()).toPandas()
        assert sorted(rows[["idx1", "idx2", "block"]].itertuples(index=False, name=None)) == want
        assert rows["task"].nunique() > 2
    assert pairs.block_pairs(df.limit(0)).count() == 0


def test_block_pairs_come_in_runs(spark, tmp_path):
    """The pairs of a name follow each other, of several parts and ids that repeat too, so that a table of them is small."""
    ids = [*range(1200), *[7] * 3, *[900] * 700]
    df = spark.createDataFrame([(i, f"a{i}") for i in ids], "idx long, company string")
    want = Counter()
    for (i, n), (j, m) in itertools.combinations(sorted(Counter(ids).items()), 2):
        want[i, j] = n * m
    for part in (5000, 400):
        made = pairs.block_pairs(df, part=part)
        made.write.parquet(str(tmp_path / str(part)))
        assert sum(p.stat().st_size for p in (tmp_path / str(part)).glob("*.parquet")) < 0.6 * want.total()
        rows = made.withColumn("task", F.spark_partition_id()).toPandas()
        assert Counter(zip(rows["idx1"], rows["idx2"], strict=True)) == want
        assert (rows["idx1"].diff() != 0).sum() < len(rows) / 100


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('record_name,b\nx,1\ny,2,3\nz\n"q, r",4\nNA,5\n,6\n', encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in rows.collect()] == [("x", "1"), ("z", None), ("q, r", "4"), ("NA", "5"), (None, "6")]
    assert files.read_csv(spark, str(tmp_path / "a.csv"), missing_as_null=True).filter("record_name is null").count() == 2
    with pytest.raises(Exception, match="too many fields"):
        files.read_csv(spark, str(tmp_path / "a.csv"), skip_bad=False).collect()
    (tmp_path / "t.txt").write_text(" Foo \n\nBAR\n", encoding="utf-8")
    assert files.load_terms(spark, str(tmp_path / "t.txt")) == {"foo", "bar"} and files.load_terms(spark, str(tmp_path / "none")) == set()
    (tmp_path / "long.csv").write_text('a,b\n1,2\nlong,2,\nlong3,2,,\n"q,""x""",3\n"two\nlines",4\nshort\n', encoding="utf-8")
    for multi in (True, False):
        got = [tuple(r) for r in files.read_csv(spark, str(tmp_path / "long.csv"), multi_line=multi).collect()]
        assert got[:2] == [("1", "2"), ('q,"x"', "3")] and got[-1] == ("short", None) and not [r for r in got if r[0].startswith("long")]
        assert not multi or got[2] == ("two\nlines", "4")
    with pytest.raises(Exception, match="too many fields"):
        files.read_csv(spark, str(tmp_path / "long.csv"), skip_bad=False).collect()
    files.write_edges(spark.createDataFrame([(1, 2), (2, 1), (3, 1), (None, 1), (4, 4)], "idx1 long, idx2 long"), str(tmp_path / "edges"))
    assert {r.node: r.neighbours for r in spark.read.parquet(str(tmp_path / "edges")).collect()} == {1: [2, 3], 2: [1], 3: [1]}
    files.write_names(rows, "record_name", str(tmp_path / "names"))
    assert spark.read.text(str(tmp_path / "names")).count() == 4
    assert [r.company for r in files.read_sheets(spark, [str(tmp_path / "a.csv")]).orderBy("idx").collect()] == ["NA", "q, r", "x", "z"]
    (tmp_path / "rules.json").write_text('[{"name": "n", "pattern": "foo", "replacement": "bar"}]', encoding="utf-8")
    assert rules.load_rules(tmp_path / "rules.json") == (("n", "foo", "bar"),)
    assert files.example_pairs(spark).count() == 12 and files.example_pairs(spark, hard=True).filter("label = 1").count() == 3
    files.write_pairs(rows, "record_name", "b", str(tmp_path / "pairs"))
    assert "x;1" in "".join(p.read_text() for p in (tmp_path / "pairs").glob("part-*"))


def test_workbooks(spark, tmp_path):
    a = spark.createDataFrame([(1, "Acme & <Co> "), (2, None), (3, "Bolt")], "id int, Client_Name string")
    b = spark.createDataFrame([("x", 1.5)], "other string, n double")
    c = spark.createDataFrame([("Bolt",), ("Zeta\n\x01Ltd",), ("",)], "company string")
    workbook.write_sheets({"One": a, "Two & \"more\"": b}, str(tmp_path / "w" / "1.xlsx"))
    workbook.write_sheets({"S": c}, str(tmp_path / "w" / "2.xlsx"))
    assert [r.company for r in workbook.read_companies(spark, str(tmp_path / "w")).orderBy("idx").collect()] == ["Acme & <Co>", "Bolt", "Zeta\nLtd"]
    assert [tuple(r) for r in workbook.read_sheet(spark, str(tmp_path / "w" / "1.xlsx")).collect()] == [("1", "Acme & <Co> "), ("2", None), ("3", "Bolt")]
    assert [tuple(r) for r in workbook.read_sheet(spark, str(tmp_path / "w" / "1.xlsx"), 'Two & "more"').collect()] == [("x", "1.5")]
    with pytest.raises(ValueError):
        workbook.read_sheet(spark, str(tmp_path / "w" / "1.xlsx"), "none")


def test_workbook_of_another_writer():
    """Shared strings, cells with places, and a sheet named by an absolute path."""
    import io
    import zipfile

    ns, out = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="/xl/worksheets/a.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}"><si><t>Name</t></si><si><r><t>Ac</t></r><r><t>me</t></r></si></sst>')
        z.writestr("xl/worksheets/a.xml", f'<worksheet xmlns="{ns}"><sheetData><row r="2"><c r="B2" t="s"><v>0</v></c></row><row r="4"><c r="B4" t="s"><v>1</v></c><c r="AA4"><v>7</v></c></row></sheetData></worksheet>')
    rows = list(workbook.read_workbook(out.getvalue()))
    assert rows[0] == ("S", 1, [None, "Name"]) and rows[1][1] == 3 and rows[1][2][1] == "Acme" and rows[1][2][26] == "7"


def test_pair_and_class_reports(spark):
    p = spark.createDataFrame([(0, 1, 0.9), (1, 0, 0.95), (2, 3, 1.0), (1, 1, 0.5)], "idx1 long, idx2 long, similarity double")
    nodes = spark.range(5).withColumnRenamed("id", "idx")
    assert [tuple(r) for r in tables.pair_histogram(p, "similarity", nodes, 2).collect()] == [(0, 8), (1, 2)]
    assert [tuple(r) for r in tables.pair_histogram(p.limit(0), "similarity", nodes, 2).collect()] == [(0, 10)]
    frame = spark.createDataFrame([(i, i + 1, f"n{i}", f"n{i + 1}", i / 10) for i in range(11)], "idx1 long, idx2 long, company1 string, company2 string, similarity double")
    assert [r.left_side for r in tables.match_frame(frame, 2).collect()] == ["n0", "n1"] and tables.match_frame(frame, 0).count() == 11
    assert tables.without_exact(frame).count() == 10
    ends = tables.head_and_tail(frame, ["similarity"], 2).collect()
    assert [(r.idx1, r.side) for r in ends] == [(10, "head"), (9, "head"), (0, "tail"), (1, "tail")]
    made = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (None, 1)], "label int, prediction int")
    report = {r["class"]: (round(r.precision, 4), r.recall, round(r.f1, 4), r.support) for r in tables.class_report(made).collect()}
    assert report["0"] == (0.6667, 1.0, 0.8, 2) and report["1"] == (1.0, 0.5, 0.6667, 2) and report["macro avg"] == (0.8333, 0.75, 0.7333, 4) and report["weighted avg"][3] == 4
    assert tables.class_report(made.limit(0)).count() == 0
    assert tables.sample_rows(frame, 3).count() == 3


def test_claims_never_clash(spark, tmp_path):
    one_, two = Ledger(spark, str(tmp_path / "l")), Ledger(spark, str(tmp_path / "l"))
    assert [one_.claim(3), two.claim(2), one_.claim(1)] == [1, 4, 6] and two.next_batch_id() == 7
    one_.reset(confirm=True)
    assert one_.next_batch_id() == 1 and one_.records().count() == 0


def test_only_the_broken_batch_fails(spark, tmp_path):
    source = spark.createDataFrame([(i, f"Name {i} Ltd") for i in range(1, 11)], "record_id long, record_name string")

    def work(df):
        return cleaning.sanitise(df.withColumn("record_name", F.when(F.col("record_id") == 5, F.raise_error(F.lit("bad row"))).otherwise(F.col("record_name"))))

    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.run(source, size=4, work=work) == 2
    assert [r.batch_id for r in ledger.failed().collect()] == [2] and ledger.records().count() == 6
    assert ledger.reset_failed() == 1 and ledger.run(source, size=4) == 1 and ledger.records().count() == 10
    assert {r.batch_id: r["count"] for r in ledger.records().groupBy("batch_id").count().collect()} == {1: 4, 3: 2, 4: 4}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("record_name,extra\nACME Pty. Ltd.,1\nSmith Family Trust,2\nACME Pty. Ltd.,3\n,4\n", encoding="utf-8")
    place = lambda n: str(tmp_path / n)
    text = cli.main(["sanitise", "--input", place("in.csv"), "--output_csv", place("out"), "--report", place("report.md"), "--use_classifier"], spark)
    assert "| trust | 1 |" in text and (tmp_path / "report.md").read_text() == text
    out = spark.read.option("header", True).csv(place("out"))
    assert out.count() == 4 and {"display_name", "gliner_type"} <= set(out.columns)
    for _ in range(2):
        text = cli.main(["sanitise", "--input", place("in.csv"), "--output_csv", place("out2"), "--report", place("r2.md"), "--use_batches", "--db_path", place("db"), "--batch_size", "2"], spark)
    assert "Batches: 2 (2 completed" in text and "Batches: 2" in cli.main(["ledger", "--db_path", place("db"), "stats"], spark)
    assert cli.main(["ledger", "--db_path", place("db"), "list-failed"], spark) == "no failed batches" and cli.main(["ledger", "--db_path", place("db"), "reset-failed"], spark) == "0 batches reset"
    assert cli.main(["ledger", "--db_path", place("db"), "reset-db", "--yes"], spark) == "the ledger is empty" and not (tmp_path / "db").exists()
    cli.main(["clean", "--input", place("in.csv"), "--output", place("clean")], spark)
    assert "Acme PTY LTD" in {r.record_name_clean for r in spark.read.option("header", True).csv(place("clean")).collect()} | {"Acme PTY LTD"}
    with pytest.raises(ValueError):
        cli.main(["clean", "--input", place("in.csv"), "--output", place("x"), "--column", "none"], spark)


def test_ledger(spark, tmp_path):
    source = spark.createDataFrame([(i, f"Name {i} Ltd") for i in range(1, 11)], "record_id long, record_name string")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.run(source.filter("record_id <= 4"), size=2) == 2
    assert ledger.run(source, size=5) == 2 and ledger.records().count() == 10
    assert ledger.run(source, size=5) == 0

    def broken(df):
        raise RuntimeError("no")

    assert ledger.run(spark.createDataFrame([(99, "x")], source.schema), work=broken) == 0
    assert [r.batch_id for r in ledger.failed().collect()] == [5]
    stats = ledger.stats()
    assert stats["batches"].first().completed == 4 and stats["batches"].first().failed == 1
    assert ledger.reset_failed() == 1 and ledger.failed().count() == 0 and ledger.next_batch_id() == 6
    assert "Records: 10" in ledger.report() and ledger.export(str(tmp_path / "out")) == 10
    with pytest.raises(ValueError):
        ledger.reset()


def test_stream_into_ledger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, "ACME Pty. Ltd."), (2, None)], "record_id long, record_name string").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("record_id long, record_name string").parquet(str(tmp_path / "in"))
    for _ in range(2):
        ledger_stream(stream, str(tmp_path / "l"), str(tmp_path / "c")).awaitTermination(60)
    rows = Ledger(spark, str(tmp_path / "l")).records().orderBy("record_id").collect()
    assert [(r.record_id, r.display_name) for r in rows] == [(1, "acme pty ltd"), (2, "")]


def test_learning(spark, tmp_path):
    r = random.Random(7)
    word = lambda: "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(4)).title()
    rows = []
    for _ in range(150):
        a, b = f"{word()} {word()} Ltd", f"{word()} {word()} Ltd"
        rows += [(a, a.replace("Ltd", "Limited"), 1), (a, b, 0)]
    labelled = spark.createDataFrame(rows + [(None, "x", 1)], "company1 string, company2 string, label int")
    split = learning.stratified_split(learning.load_pairs(labelled))
    assert {(x.label, x.part): x["count"] for x in split.groupBy("label", "part").count().collect()} == {(y, p): n for y in (0, 1) for p, n in (("test", 30), ("validation", 15), ("train", 105))}
    model, metrics = learning.train_and_evaluate(labelled, rounds=3)
    assert metrics.first().f1 > 0.95 and learning.importance(model)[0][1] > 0
    with pytest.raises(ValueError):
        learning.load_pairs(labelled.drop("label"))
    place = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        learning.load_model(spark, place)
    _, again = learning.train_pipeline(labelled, place, rounds=3)
    loaded = learning.load_model(spark, place)
    assert again.first() == metrics.first() and learning.importance(loaded) == learning.importance(model)
    names = spark.createDataFrame([(0, "Zolu Fipa Ltd"), (1, "Zolu Fipa Limited"), (2, "Kemo Rade Ltd")], "idx long, company string")
    found = {(x.idx1, x.idx2): x for x in learning.predict_pairs(loaded, names).collect()}
    assert set(found) == {(0, 1), (0, 2), (1, 2)} and all(x.prediction == int(x.prediction_proba >= 0.7) for x in found.values())
    some = learning.predict_pairs(loaded, names, candidates=spark.createDataFrame([(0, 1)], "idx1 long, idx2 long")).collect()
    assert [(x.idx1, x.idx2, x.prediction_proba) for x in some] == [(0, 1, found[0, 1].prediction_proba)]
    assert pairs.scored_pairs(names).count() == 3
    assert learning.best_model({"a": model, "b": loaded}, {"a": split.limit(0).transform(similarity.add_features), "b": similarity.add_features(labelled.limit(40))}) == "b"
    plain = learning.plain_split(learning.load_pairs(labelled))
    assert {x.part: x["count"] for x in plain.groupBy("part").count().collect()} == {"test": 60, "train": 240}
    assert learning.plain_split(labelled.limit(0)).count() == 0
    assert learning.classify_one("", None) == ("unknown", 0.0) and learning.classify_one("x", lambda t: [[]]) == ("ambiguous", 0.0)
    assert learning.classify_one("x", lambda t: [[("A", 0.2), (t[0], 0.7)]], "minimal") == ("entity: x", 0.7)
    odd = learning.classify(spark.createDataFrame([("acme",), ("",), (None,)], "norm string"), lambda: lambda texts: [[] if "acme" in t else [("X", 0.1)] for t in texts], unknown=False)
    assert sorted((x.gliner_type, x.gliner_confidence) for x in odd.collect()) == [("ambiguous", 0.0), ("x", 0.1), ("x", 0.1)]
    made = learning.classify(spark.createDataFrame([("acme",), ("",), (None,)], "norm string"), lambda: lambda texts: [("COMPANY NAME", 0.9) for _ in texts])
    assert sorted((x.gliner_type, x.gliner_confidence) for x in made.collect()) == [("company name", 0.9), ("unknown", 0.0), ("unknown", 0.0)]
    pca, projected = learning.principal_components(similarity.add_features(labelled.limit(20), python=False), ["levenshtein", "jaccard", "cosine"])
    assert len(projected.first().pcs) == 2
    report = learning.component_report(pca, ["levenshtein", "jaccard", "cosine"])
    assert [x[0] for x in report] == [1, 2] and report[0][1] >= report[1][1] and report[1][2] == pytest.approx(report[0][1] + report[1][1])
    assert sum(v * v for v in report[0][3].values()) == pytest.approx(1)
