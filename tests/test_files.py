"""Readers, writers and whole jobs over text files."""

import pytest

from wordloom.__main__ import main
from wordloom.plans import jobs
from wordloom.sources import corpus, side_files


@pytest.fixture
def write(tmp_path):
    def to(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
        return str(path)

    return to


def read(spark, path):
    return [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]


def test_lines_and_documents(spark, write, tmp_path):
    write("c/one.txt", "x\r\ny\rz\n\nw\n")
    write("c/none.txt", "")
    rows = corpus.read_lines(spark, str(tmp_path / "c")).collect()
    assert [(r["doc_id"], r["line"]) for r in rows] == [("one.txt", x) for x in ["x", "y", "z", "", "w"]]
    whole = corpus.read_documents(spark, str(tmp_path / "c")).collect()
    assert {r["doc_id"]: r["text"] for r in whole}["one.txt"] == "x\r\ny\rz\n\nw\n"


def test_tables_are_dealt_out_on_request_only(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    plan = corpus.read_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert corpus.read_table(spark, path, partitions=7).rdd.getNumPartitions() == 7


def test_numbered_lines(spark, write, tmp_path):
    write("c/a one+two.txt", "x\ny\n")
    write("c/b.txt", "z\n")
    rows = corpus.read_numbered_lines(spark, str(tmp_path / "c")).collect()
    assert sorted((r["doc_id"], r["line_no"], r["n_lines"], r["line"]) for r in rows) == [
        ("a%20one+two.txt", 0, 2, "x"), ("a%20one+two.txt", 1, 2, "y"), ("b.txt", 0, 1, "z"),
    ]
    assert sorted(corpus.read_names(spark, str(tmp_path / "c")).collect()) == [("a%20one+two.txt",), ("b.txt",)]
    names = {r["doc_id"] for r in corpus.read_lines(spark, str(tmp_path / "c")).collect()}
    assert names == {r["doc_id"] for r in rows}


def split_small(spark):
    """Cut files into blocks of a few bytes, each a partition."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def splits(spark):
    yield lambda: split_small(spark)
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("first", [True, False])
def test_numbers_stay_when_files_are_cut_in_another_way(spark, write, tmp_path, splits, first):
    for name in "ab":
        write(f"c/{name}.txt", "".join(f"{name} line {i}\n" for i in range(200)))
    write("df", "".join(f"t{i}\t{i % 9}\n" for i in range(300)))
    if first:
        splits()
    numbered = corpus.read_numbered_lines(spark, str(tmp_path / "c"))
    ranks = side_files.read_document_frequencies(spark, str(tmp_path / "df"))
    splits()
    for table in (numbered, ranks):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan  # the files are scanned once, before
    found = sorted((r["doc_id"], r["line_no"], r["n_lines"], r["line"]) for r in numbered.collect())
    assert found == [(f"{n}.txt", i, 200, f"{n} line {i}") for n in "ab" for i in range(200)]
    assert sorted((r["idx"], r["term"], r["df"]) for r in ranks.collect()) == [(i, f"t{i}", i % 9) for i in range(300)]


def test_document_frequencies_of_files_in_one_block_and_in_many(spark, write, tmp_path, splits):
    for i in range(30):
        write(f"c/{i}.txt", "".join(f"word{j % (i + 1)} running the\n\n" for j in range(i)))
    corpora = str(tmp_path / "c")
    jobs.document_frequency(spark, corpora, str(tmp_path / "whole"))
    whole = read(spark, tmp_path / "whole")
    assert "run\t29" in whole and "word0\t29" in whole and "word28\t1" in whole and "\t29" in whole
    blocks = corpus.read_blocks(spark, corpora)
    assert blocks.where("not whole").count() == 0
    splits()
    blocks = corpus.read_blocks(spark, corpora)
    assert blocks.where("not whole").count() > 0 and blocks.where("whole").count() > 0
    jobs.document_frequency(spark, corpora, str(tmp_path / "cut"))
    assert read(spark, tmp_path / "cut") == whole


def test_a_cluster_has_to_name_its_shared_folder(spark, monkeypatch):
    from wordloom.sources import kept

    class Context:
        master = "spark://somewhere"
        getCheckpointDir = lambda self: None
        getConf = lambda self: {}

    class Session:
        sparkContext = Context()

    class Rows:
        sparkSession = Session()

    with pytest.raises(ValueError, match="checkpoint"):
        kept.shared_folder(Rows())


def test_stop_lists(spark, write):
    one = write("s1", "a\r\n\r\nde \r\nbeen\r\n\r\na\r\n")
    two = write("s2", "b\na\n")
    assert sorted(side_files.read_stop_patterns(spark, one, two)) == ["a", "b", "been", "de "]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        side_files.read_stop_patterns(spark, one + ".missing")


def test_vocabulary_and_counts(spark, write):
    path = write("v", "a\t3\n\t2\nb\t1\nb\t7\nbad\tx\none\nx\ty\t1\n")
    assert {r["word"] for r in side_files.read_vocabulary(spark, path).collect()} == {"a", "", "b", "bad", "one", "x"}
    counts = side_files.read_word_counts(spark, path).collect()
    assert {r["word"]: r["n"] for r in counts} == {"a": 3, "": 2, "b": 7}
    ranked = write("r", "d\t50\n\t44\na\t44\nd\t1\nbad\n")
    rows = side_files.read_document_frequencies(spark, ranked).collect()
    assert [(r["term"], r["df"], r["idx"]) for r in sorted(rows, key=lambda r: r["idx"])] == [("", 44, 1), ("a", 44, 2), ("d", 1, 3)]


def test_line_numbers_across_blocks(spark, write):
    lines = "".join(f"t{i}\t{i}\n" for i in range(3000))
    path = write("many", lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        ranked = side_files.read_document_frequencies(spark, path)
        assert ranked.select("idx").distinct().count() == 3000
        assert ranked.where("idx <> df").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_cooccurrence_jobs(spark, write, tmp_path):
    write("c/one.txt", "A x the b a a\n")
    stop = write("stop", "the \n")
    out = {name: tmp_path / name for name in ("counts", "top", "pairs", "stripes")}
    jobs.word_count(spark, str(tmp_path / "c"), str(out["counts"]), [stop])
    assert read(spark, out["counts"]) == ["a\t3", "b\t1", "x\t1"]
    jobs.top(spark, str(out["counts"]), str(out["top"]), k=2)
    assert read(spark, out["top"]) == ["a\t3", "b\t1"]
    main(["pairs", str(tmp_path / "c"), str(out["top"]), str(out["pairs"]), "-d", "2", "--skip-patterns", stop])
    assert read(spark, out["pairs"]) == ["a,a\t1", "a,b\t3"]
    main(["stripes", str(tmp_path / "c"), str(out["top"]), str(out["stripes"]), "-d", "2", "--skip-patterns", stop])
    assert read(spark, out["stripes"]) == ["a\t[1, 1]", "b\t[2, 0]"]
    main(["stripes", str(tmp_path / "c"), str(out["top"]), str(tmp_path / "sparse"), "-d", "2", "--sparse", "--skip-patterns", stop])
    assert read(spark, tmp_path / "sparse") == ["a\t0\t1", "a\t1\t1", "b\t0\t2"]


def test_score_jobs(spark, write, tmp_path):
    write("c/1.txt", "running runs\n...cats\n")
    write("c/2.txt", "run")
    out = {name: tmp_path / name for name in ("df", "top", "scores", "running")}
    jobs.document_frequency(spark, str(tmp_path / "c"), str(out["df"]))
    assert read(spark, out["df"]) == ["\t1", "cat\t1", "run\t2"]
    jobs.top(spark, str(out["df"]), str(out["top"]), k=2)
    assert read(spark, out["top"]) == ["run\t2", "\t1"]
    jobs.tf_idf(spark, str(tmp_path / "c"), str(out["top"]), str(out["scores"]), n_docs=6)
    scores = sorted(line.split("\t") for line in read(spark, out["scores"]))
    assert [(d, t, round(float(s), 6)) for d, t, s in scores] == [
        ("1.txt", "", 1.098612), ("1.txt", "run", 1.386294), ("2.txt", "", 0.0), ("2.txt", "run", 0.693147),
    ]
    main(["tf_idf", str(tmp_path / "c"), str(out["top"]), str(out["running"]), "--running"])
    scores = {tuple(line.split("\t")[:2]): float(line.split("\t")[2]) for line in read(spark, out["running"])}
    assert scores["1.txt", "run"] == pytest.approx(4 * -0.405465, abs=1e-5)
    assert scores["1.txt", ""] == pytest.approx(0.0)
