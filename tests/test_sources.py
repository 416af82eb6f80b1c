import gzip

import pytest

from linkrank import jobs
from linkrank import operators as g
from linkrank import sources as s
from linkrank.__main__ import main, parser
from linkrank.plans import Scratch, scratch

DUMP = """-- a comment (1,0,'no',0)
INSERT INTO `page` VALUES (1,0,'Other',0);
INSERT INTO `pagelinks` VALUES (1,0,'Plain',0),(2,1,'Talk',0),(3,0,'From_talk',4),(1,0,'Plain',0);
 INSERT INTO `pagelinks` VALUES (9,0,'Indented',0);
INSERT INTO `pagelinks` VALUES (4,0,'It\\'s_(5,0,',0),(5,0,'Back\\\\slash',0),(6,0,'Q\\"uote',0);
INSERT INTO `pagelinks` VALUES (7,0,'\\\\\\'mix',0),(8,0,'',0),(10,0,'é x',00);
"""
LINKS = [
    (1, "Plain"), (1, "Plain"), (4, "It's_(5,0,"), (5, "Back\\slash"), (6, 'Q\\"uote'),
    (7, "\\'mix"), (8, ""), (10, "é x"),
]


@pytest.mark.parametrize("zipped", [False, True])
def test_parse_link_dump(spark, tmp_path, zipped):
    path = tmp_path / ("dump.sql.gz" if zipped else "dump.sql")
    data = DUMP.encode()
    path.write_bytes(gzip.compress(data) if zipped else data)
    found = [tuple(row) for row in s.parse_link_dump(spark, str(path)).collect()]
    assert sorted(found) == sorted(LINKS)


def test_packed_dumps_are_spread_only_if_few(spark, tmp_path, monkeypatch):
    for k in range(3):
        (tmp_path / f"dump-{k}.sql.gz").write_bytes(gzip.compress(DUMP.encode()))

    def planned():
        found = s.parse_link_dump(spark, str(tmp_path))
        assert found.count() == 3 * len(LINKS)
        return found._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in planned()
    monkeypatch.setattr("linkrank.sources.link_dump.PACKED_BYTES_PER_PARTITION", 20)
    assert "Exchange hashpartitioning(xxhash64(value" in planned()


def test_long_dump_line(spark, tmp_path):
    path = tmp_path / "dump.sql"
    title = "x\\'" * 20000
    tuples = ",".join(f"({k},0,'{title if k == 5 else k}',0)" for k in range(20000))
    path.write_text(f"INSERT INTO `pagelinks` VALUES {tuples};\n")
    links = s.parse_link_dump(spark, str(path))
    assert links.count() == 20000
    assert links.where("source_id = 5").first()["target_title"] == "x'" * 20000


def test_resolve_page_ids(spark):
    links = spark.createDataFrame([(1, "b"), (2, "c"), (9, "a")], "source_id long, target_title string")
    pages = spark.createDataFrame([(1, "a"), (2, "b")], "id long, title string")
    found = {tuple(row) for row in s.resolve_page_ids(links, pages).collect()}
    assert found == {("a", "b"), ("b", "c")}


def test_edge_csv_is_read_by_name_and_survives_quotes(spark, tmp_path):
    rows = [('say "hi"', "a,b"), ("back\\slash", "quote'"), ("007", None), ("a,\\", '"')]
    frame = spark.createDataFrame(rows, "source string, target string")
    s.write_csv(frame.selectExpr("1 AS extra", "target", "source"), str(tmp_path / "csv"))
    found = [tuple(row) for row in s.read_edge_csv(spark, str(tmp_path / "csv")).collect()]
    assert sorted(found, key=repr) == sorted(rows, key=repr)


def test_jobs_end_to_end(spark, tmp_path):
    (tmp_path / "edges.csv").write_text("source,target\na,b\nb,c\nc,a\na,b\nx,y\n")
    graph, out = str(tmp_path / "graph") + "/", str(tmp_path / "out")
    built = jobs.build_job(spark, str(tmp_path / "edges.csv"), graph)
    assert tuple(built["stats"].first())[:2] == (5, 4)
    vertices, edges = s.load_graph(spark, graph)
    assert edges.count() == 4

    ranked = jobs.pagerank_job(spark, graph, out + "/ranks/", iterations=3, top_k=2)
    assert spark.read.parquet(out + "/ranks").count() == 5
    top = spark.read.option("header", True).csv(out + "/ranks_top2")
    assert top.columns == ["id", "rank"] and top.count() == 2
    assert ranked["top"].count() == 2

    found = jobs.components_job(spark, graph, out + "/parts/")
    assert found["count"].first()[0] == 2
    sizes = spark.read.option("header", True).csv(out + "/parts_summary").collect()
    assert {tuple(row) for row in sizes} == {("a", "3"), ("x", "2")}

    groups = jobs.communities_job(spark, graph + "edges", out + "/groups", max_iter=4)
    assert spark.read.parquet(out + "/groups").count() == 5
    assert groups["history"].count() == 4

    results = jobs.analysis_job(
        spark, graph, out, ranks_path=out + "/ranks", path_from="a", path_to="c"
    )
    assert [row["node"] for row in sorted(results["path"].collect())] == ["a", "b", "c"]
    assert results["best"].count() == 15
    assert spark.read.option("header", True).csv(out + "/in_degree").count() == 2


def test_dump_job_feeds_the_builder(spark, tmp_path):
    (tmp_path / "dump.sql").write_text(DUMP)
    pages = spark.createDataFrame([(k, f"P{k}") for k in range(1, 8)], "id long, title string")
    pages.write.parquet(str(tmp_path / "pages"))
    jobs.dump_job(spark, str(tmp_path / "dump.sql"), str(tmp_path / "csv"), str(tmp_path / "pages"))
    found = {tuple(row) for row in s.read_edge_csv(spark, str(tmp_path / "csv")).collect()}
    assert found == {(f"P{k}", title) for k, title in LINKS if k < 8}


def test_command_line(spark, tmp_path, capsys):
    options = parser().parse_args(["pagerank", "--graph", "g", "--output", "o", "--top-k", "7"])
    assert (options.iterations, options.damping, options.top_k) == (20, 0.85, 7)
    (tmp_path / "edges.csv").write_text("source,target\na,b\n")
    main(["build", "--edges-path", str(tmp_path / "edges.csv"), "--output", str(tmp_path / "g")])
    assert "n_vertices" in capsys.readouterr().out


def test_scratch_tables_live_in_the_checkpoint_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    space = Scratch(spark)
    assert space.folder.startswith(shared)
    table = space.write(spark.range(3), "t")
    assert table.count() == 3
    space.drop("t", "never_written")
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND"):
        spark.read.parquet(space.path("t"))


def test_cluster_sessions_must_name_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())


def test_operators_leave_only_their_result_behind(spark):
    import os

    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    g.pagerank(g.vertex_degrees(edges), edges, iterations=3)
    g.connected_components(g.vertex_degrees(edges), edges)
    g.label_propagation(edges)
    g.distances_to(edges, "c")
    made = set(os.listdir(shared)) - before
    assert len(made) == 4
    for folder in made:
        assert [n for n in os.listdir(f"{shared}/{folder}") if not n.startswith(".")] == ["result"]


def test_csv_keeps_blanks_and_refuses_line_breaks(spark, tmp_path):
    rows = [(" lead", "trail "), ('"quoted"', "back\\slash"), (" ", "a,b"), (None, "'")]
    frame = spark.createDataFrame(rows, "source string, target string")
    s.write_csv(frame, str(tmp_path / "kept"))
    found = {tuple(row) for row in s.read_edge_csv(spark, str(tmp_path / "kept")).collect()}
    assert found == set(rows)
    broken = spark.createDataFrame([("l1\nl2", "z")], "source string, target string")
    with pytest.raises(Exception, match="line break in source"):
        s.write_csv(broken, str(tmp_path / "broken"))


def test_resolving_salts_heavy_pages_alone(spark, monkeypatch):
    links = spark.createDataFrame([(1, "a")] * 6 + [(2, "b"), (3, "c")], "source_id long, target_title string")
    pages = spark.createDataFrame([(1, "one"), (2, "two")], "id long, title string")
    expected = [("one", "a")] * 6 + [("two", "b")]
    for least, salted in ((7, False), (6, True)):
        monkeypatch.setattr("linkrank.plans.skew.HOT_ROWS", least)
        found = s.resolve_page_ids(links, pages)
        assert ("salt" in found._jdf.queryExecution().analyzed().toString()) == salted
        assert sorted(map(tuple, found.collect())) == expected
