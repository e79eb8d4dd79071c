"""The whole job on a dump made from the test documents, and its written outputs."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel

import __spark_entry__ as contract
from pageloom import storage
from pageloom.plans import pipeline
from pageloom.plans.relations import nested_pages
from pageloom.sinks.tables import under


@pytest.fixture(scope="module")
def dump(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dump") / "pages")
    nested_pages(spark, sf_dir).write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    return path


def test_full_pipeline(spark, dump, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline.nlp, "__defaults__", (10, None, 2))
    out = str(tmp_path / "out")
    result = pipeline.run_pipeline(spark, dump, out, k=2)
    read = lambda name: spark.read.parquet(under(out, name))

    written = read("pages")
    assert written.columns == [*pages.columns, "record"] and written.where("record IS NOT NULL").isEmpty()
    written = written.drop("record")
    assert written.drop("timestamp").exceptAll(pages.drop("timestamp")).isEmpty()
    assert written.count() == pages.count()

    assert result["stats"].pop("overview_ratios").count() == 1
    assert result["nlp"]["text_head"].count() == 3
    for name, table in result["stats"].items():
        assert read(name).columns == table.columns and read(name).count() == table.count()
    overview = read("overview").first()
    assert overview.out_dir == out and overview.columns == pages.columns
    assert overview.total_pages == pages.count()

    for part in ("clusters", "topics"):
        key = part[:-1]
        assigned, labeled = read(f"{part}/assignments"), read(f"{part}/assignments_labeled")
        assert assigned.count() == labeled.count() == result["nlp"][f"{part}/assignments"].count()
        assert {key, f"{key}_name", "id", "title"} == set(labeled.columns)
        assert read(f"{part}/labels").count() == 2
        assert len(PipelineModel.load(under(out, f"{part}/model")).stages) >= 6

    nodes = spark.read.option("header", True).csv(under(out, "graph/nodes_csv"))
    edges = spark.read.option("header", True).csv(under(out, "graph/edges_csv"))
    assert nodes.columns == ["id", "title", "kind"]
    assert edges.columns == ["src_id", "dst_id", "weight", "edge_type"]
    assert nodes.count() == result["graph"]["vertices"].count()
    assert edges.count() == result["graph"]["edges"].count()
    assert result["graph"]["top_pages"].count() == 10


def test_one_pass_gives_pages_and_rejects(spark, dump, pages, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    good = "<page><title>T{0}</title><ns>0</ns><id>{0}</id><revision><id>1</id><text>x [[A]]</text></revision></page>"
    (folder / "a.xml").write_text("<mediawiki>" + "".join(good.format(i) for i in range(5)) + "<page><title>bad & broken</title><id>7</id></page><page><ns>zero</ns></page></mediawiki>")
    out = str(tmp_path / "out")
    found = pipeline.ingest(spark, str(folder), out)
    assert sorted(r.id for r in found.select("id").collect()) == list(range(5)) and found.columns == pages.columns
    assert sorted(r.record for r in spark.read.parquet(under(out, "rejected_pages")).select("record").collect()) == sorted(
        r.record for r in pipeline.rejected_pages(spark, str(folder)).collect()
    )
    pipeline.ingest(spark, dump, out)  # no reject: an empty table takes the place of the old one
    assert spark.read.parquet(under(out, "rejected_pages")).count() == 0
    assert spark.read.parquet(under(out, "pages")).count() == pages.count()


def test_a_failed_run_leaves_the_old_set_and_is_taken_up_again(spark, dump, pages, tmp_path, monkeypatch):
    from pageloom.sinks.published import published_folder, published_versions, read_published

    out, ran = str(tmp_path / "published"), []
    works = {}

    def small(name, fails=False):
        def work(*args):
            ran.append(name)
            folder = args[2] if name in ("nlp",) else args[1]
            if fails:
                raise RuntimeError("lost")
            spark.range(3).write.mode("overwrite").parquet(under(folder, name))
            return {t: spark.range(2) for t in ("counts", "pagerank", "top_pages", "top_categories")}

        works[name] = work
        return work

    for name in ("corpus_stats", "nlp", "page_graph"):
        monkeypatch.setattr(pipeline, name, small(name))
    with pytest.raises(FileNotFoundError):
        published_folder(spark, out)
    first = pipeline.publish_pipeline(spark, dump, out, k=2)
    assert published_folder(spark, out) == first and ran == ["corpus_stats", "nlp", "page_graph"]
    assert read_published(spark, out, "pages").count() == pages.count()
    assert pipeline.publish_pipeline(spark, dump, out, k=2) == first and len(ran) == 3  # nothing to do again

    ran.clear()
    monkeypatch.setattr(pipeline, "nlp", small("nlp", fails=True))
    with pytest.raises(RuntimeError):
        pipeline.publish_pipeline(spark, dump, out, k=3)
    assert published_folder(spark, out) == first and read_published(spark, out, "nlp").count() == 3
    monkeypatch.setattr(pipeline, "nlp", small("nlp"))
    ingested = []
    monkeypatch.setattr(pipeline, "ingest", lambda *args: ingested.append(args))
    second = pipeline.publish_pipeline(spark, dump, out, k=3)
    assert ran == ["corpus_stats", "nlp", "nlp", "page_graph"] and not ingested
    assert second != first and published_versions(spark, out) == [first.split("/")[-1], second.split("/")[-1]]
    monkeypatch.undo()
    for name in ("corpus_stats", "nlp", "page_graph"):
        monkeypatch.setattr(pipeline, name, works[name])
    third = pipeline.publish_pipeline(spark, dump, out, k=4)
    assert published_folder(spark, out) == third and len(published_versions(spark, out)) == 2
    assert not (tmp_path / "published/versions" / first.split("/")[-1]).exists()


def test_the_full_job_trains_and_ranks_in_full(spark, tmp_path, monkeypatch):
    """The registered job gives its stages no fewer rounds and no smaller reports than they have by themselves."""
    from pageloom.operators import models, pagerank
    from pageloom.plans import queries

    rows = [(i, f"alpha beta w{i}", "en", "web") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    given = {}
    monkeypatch.setattr(pipeline, "corpus_stats", lambda pages, out, *args: given.update(pages=pages.count(), stats=args))
    monkeypatch.setattr(pipeline, "nlp", lambda pages, k, out, *args: given.update(nlp=(k, *args)))
    ranked = dict.fromkeys(("counts", "pagerank", "top_pages", "top_categories"), spark.range(1))
    monkeypatch.setattr(pipeline, "page_graph", lambda pages, out, *args: given.update(graph=args) or ranked)
    monkeypatch.setattr(queries, "_read_back", lambda spark, folder, tables: folder)
    queries.full_job(spark, str(tmp_path))
    assert given == {"pages": 30, "stats": (25,), "nlp": (10, models.MAX_ITER, pipeline.tk.LETTERS_ONLY), "graph": (pagerank.MAX_ITER, 10)}


def test_single_file_csv(spark, pages, tmp_path):
    out = tmp_path / "out"
    pipeline.page_graph(pages, str(out), max_iter=1, single_file=True)
    assert len(list((out / "graph/nodes_csv").glob("part-*"))) == 1


def test_nothing_is_written_without_a_target(spark, dump, pages):
    parsed = pipeline.ingest(spark, dump)
    assert parsed.count() == pages.count()
    assert "top_tokens" in pipeline.corpus_stats(parsed)


def test_paths_keep_their_scheme():
    assert under("hdfs://host/x/", "overview") == "hdfs://host/x/overview"


def test_durable_tables_live_in_the_checkpoint_folder(spark):
    table = storage.durable(spark.range(10).toDF("n"), "numbers")
    assert storage.shared_folder(spark).removeprefix("file:") in table.inputFiles()[0]
    assert table.count() == 10


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session)


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["id", "title", "kind", "pagerank"] and found.count() == 10
