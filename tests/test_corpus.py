"""Corpus files (S1-S4, F6, A3, J1, J2) on literal files."""

import io
import os
import tarfile
import tempfile

import pytest
from pyspark.sql import functions as F

from vecdex.operators import corpus
from vecdex.sources import tsv


def _write(text: str, name: str, newline: str = "\n") -> str:
    d = tempfile.mkdtemp(prefix="vecdex-test-")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8", newline=newline) as f:
        f.write(text)
    return p


def meta_line(mid, title, date, genres):
    return "\t".join([mid, "fb", title, date, "", "", "", "", genres])


META = "\n".join([
    meta_line("1", "Alpha", "1999-05-17", '{"a": "Drama", "b": "Comedy"}'),
    meta_line("2", '"Quoted" Title', "2001", "{}"),
    meta_line("3", "Gamma", "2000-99-99", '{"x": "A", "y": "B", "x": "C"}'),
    meta_line("1", "Alpha v2", "2005-01-01", '{"a": "Thriller"}'),   # duplicate id
    meta_line("4", "NoSummary", "", "{}"),
]) + "\n"

SUMM = "\n".join([
    "1\t" + "x" * 400,
    "2\tshort\twith tab",
    "3",                      # no tab -> empty summary
    "5\tno metadata",
]) + "\n"


def test_metadata_and_summaries_join(spark):
    meta = tsv.metadata_rows(tsv.text_lines(spark, _write(META, "m.tsv")))
    summ = tsv.summary_rows(tsv.text_lines(spark, _write(SUMM, "s.txt")))
    rec = {r["movie_id"]: r for r in corpus.join_records(meta, summ).collect()}
    assert sorted(rec) == ["1", "2", "3"]
    # last row wins for duplicate ids, first position kept
    assert rec["1"]["title"] == "Alpha v2" and rec["1"]["release_year"] == 2005
    assert rec["1"]["genres"] == ["Thriller"]
    assert rec["1"]["ordinal"] < rec["2"]["ordinal"]
    assert len(rec["1"]["summary_snippet"]) == 300
    assert rec["2"]["title"] == '"Quoted" Title' and rec["2"]["release_year"] is None
    assert rec["2"]["genres"] == [] and rec["2"]["summary_snippet"] == "short\twith tab"
    assert rec["3"]["genres"] == ["C", "B"] and rec["3"]["release_year"] == 2000
    assert rec["3"]["summary_snippet"] == ""
    ex = {(r["movie_id"], r["reason"]) for r in corpus.exclusions(meta, summ).collect()}
    assert ex == {("4", "no_summary"), ("5", "no_metadata")}


def test_crlf_line_ends(spark):
    meta = tsv.metadata_rows(tsv.text_lines(spark, _write(META, "m.tsv", newline="\r\n")))
    assert {r["movie_genres"] for r in meta.where(F.col("movie_id") == "2").collect()} == {"{}"}


@pytest.mark.parametrize("bad", [meta_line("9", "t", "", "{}").rsplit("\t", 1)[0], ""])
def test_short_row_is_strict_failure(spark, bad):
    p = _write(META + bad + "\n" + META, "bad.tsv")
    with pytest.raises(Exception):
        tsv.metadata_rows(tsv.text_lines(spark, p)).collect()
    lenient = tsv.metadata_rows(tsv.text_lines(spark, p), strict=False).count()
    assert lenient == 10
    assert tsv.metadata_rejects(tsv.text_lines(spark, p)).count() == 1


def _tar(members: dict[str, str]) -> str:
    d = tempfile.mkdtemp(prefix="vecdex-tar-")
    p = os.path.join(d, "corpus.tar.gz")
    with tarfile.open(p, "w:gz") as t:
        for name, text in members.items():
            data = text.encode("utf-8")
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return p


def test_archive_members_by_basename(spark):
    p = _tar({"dataset/movie.metadata.tsv": META,
              "dataset/plot_summaries.txt": SUMM,
              "dataset/README.txt": "ignore me\n"})
    lines = tsv.archive_lines(spark, os.path.dirname(p)).cache()
    assert {r["member"] for r in lines.select("member").distinct().collect()} == \
        {"movie.metadata.tsv", "plot_summaries.txt"}
    meta = tsv.metadata_rows(tsv.member_lines(lines, "movie.metadata.tsv"))
    summ = tsv.summary_rows(tsv.member_lines(lines, "plot_summaries.txt"))
    assert corpus.join_records(meta, summ).count() == 3
    every = tsv.archive_lines(spark, os.path.dirname(p), members=None)
    assert every.select("member").distinct().count() == 3
    assert tsv.line_count(tsv.member_lines(lines, "plot_summaries.txt")).first()["label"] == "4"


def test_corrupt_archive_fails(spark):
    d = tempfile.mkdtemp(prefix="vecdex-tar-")
    with open(os.path.join(d, "broken.tar.gz"), "wb") as f:
        f.write(b"not a tar file at all")
    with pytest.raises(Exception):
        tsv.archive_lines(spark, d).collect()


def test_line_count_thousands(spark):
    p = _write("".join(f"{i}\tt\n" for i in range(1234)), "s.txt")
    assert tsv.line_count(tsv.text_lines(spark, p)).first()["label"] == "1,234"


def test_line_order_over_files(spark, tmp_path):
    """A small first file and a larger second one: the later file's row wins."""
    (tmp_path / "a.tsv").write_text("k\told\n")
    (tmp_path / "b.tsv").write_text("".join(f"x{i}\t{'y' * 50}\n" for i in range(500)) + "k\tnew\n")
    lines = tsv.text_lines(spark, str(tmp_path))
    rows = corpus.last_wins(tsv.summary_rows(lines), "movie_id")
    assert rows.where("movie_id = 'k'").first().summary == "new"
    first = rows.orderBy("ordinal").first()
    assert first.movie_id == "k" and rows.count() == 501
