from pressledger.schemas import ARTICLE_COLUMNS
from pressledger.streaming.ingest import append_cleaned, stream_csv

HEADER = ",".join(ARTICLE_COLUMNS)


def test_new_files_are_cleaned_once(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    line = '{},"Two\nlines",Acme,2023-05-12,AI/ML,{},s,u,a,5'
    (folder / "one.csv").write_text("\n".join([HEADER, line.format("a1", "$5M"), line.format("a2", "")]) + "\n")
    append_cleaned(stream_csv(spark, str(folder)), out, state).awaitTermination()
    (folder / "two.csv").write_text("\n".join([HEADER, line.format("a3", "€1B")]) + "\n")
    append_cleaned(stream_csv(spark, str(folder)), out, state).awaitTermination()
    rows = {r.article_id: r for r in spark.read.parquet(out).collect()}
    assert {k: (r.arr_usd, r.arr_parse_status, r.source_file) for k, r in rows.items()} == {
        "a1": (5_000_000, "PARSED", "one.csv"), "a2": (None, "MISSING", "one.csv"), "a3": (1_100_000_000, "PARSED", "two.csv"),
    }
    assert spark.read.parquet(out).count() == 3
