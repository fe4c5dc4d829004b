import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.registry import QUERIES
from tidemark.sources.io import read_posts, read_word_vectors, write_predictions

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings pages benchmark labels conversations".split()


def test_csv_scan_quoted_multiline_and_file_name(spark):
    d = tempfile.mkdtemp(prefix="tidemark-csv-")
    with open(os.path.join(d, "MatchA.csv"), "w") as f:
        f.write('ID,MatchID,PeriodID,EventType,Timestamp,Tweet\n'
                '1_0,1,0,1.0,100,"GOAL!!! ""what""\nsecond line"\n'
                '1_0,1,0,1.0,101,\n')
    with open(os.path.join(d, "MatchB.csv"), "w") as f:
        f.write('ID,MatchID,PeriodID,EventType,Timestamp,Tweet\n2_5,2,5,,102,hello\n')
    df = read_posts(spark, d)
    rows = sorted(df.collect(), key=lambda r: (r.source_file, r.ts))
    assert [r.source_file for r in rows] == ["MatchA.csv", "MatchA.csv", "MatchB.csv"]
    assert rows[0].text == 'GOAL!!! "what"\nsecond line'
    assert rows[1].text is None and rows[2].event_type is None
    assert len({r.post_id for r in rows}) == 3
    out = os.path.join(d, "pred")
    write_predictions(df.select("id", "event_type"), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["ID", "EventType"] and back.count() == 3


def _csv(d, name, header, *rows):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_files_to_score_and_other_column_orders(spark):
    d = tempfile.mkdtemp(prefix="tidemark-csv-")
    _csv(d, "Train.csv", "ID,MatchID,PeriodID,EventType,Timestamp,Tweet", "1_0,1,0,1.0,100,hello", "1_1,1,1,0.0,101,x")
    _csv(d, "Eval.csv", "ID,MatchID,PeriodID,Timestamp,Tweet", "2_0,2,0,1404575400000,\"two\nlines\"")
    _csv(d, "Mixed.csv", "Tweet,Timestamp,Extra,PeriodID,MatchID,ID", "bye,7,zz,5,3,3_5")
    got = {r.id: r for r in read_posts(spark, d).collect()}
    assert len(got) == 4 and len({r.post_id for r in got.values()}) == 4
    assert got["1_0"].event_type == 1.0 and got["2_0"].event_type is None
    assert (got["2_0"].ts, got["2_0"].text, got["2_0"].period_id) == (1404575400000, "two\nlines", 0)
    assert (got["3_5"].text, got["3_5"].ts, got["3_5"].match_id, got["3_5"].period_id) == ("bye", 7, "3", 5)
    assert got["3_5"].source_file == "Mixed.csv" and "Extra" not in got["3_5"].asDict()
    only = tempfile.mkdtemp(prefix="tidemark-csv-")
    _csv(only, "Eval.csv", "ID,MatchID,PeriodID,Timestamp,Tweet", "2_0,2,0,1,a", "2_0,2,0,2,b")
    assert sorted(r.text for r in read_posts(spark, only, multi_line=False).collect()) == ["a", "b"]


def test_lemma_and_lexicon_sources(spark):
    from tidemark.sources.io import read_lemmas, read_lexicon
    d = tempfile.mkdtemp(prefix="tidemark-res-")
    _csv(d, "lemmas.txt", "geese goose", "feet\tfoot", "", "odd")
    _csv(d, "lexicon.txt", "good\t1.9\t0.5\t[1, 2]", "bad -2.5", "broken x", "")
    assert sorted(read_lemmas(spark, os.path.join(d, "lemmas.txt")).collect()) == [("feet", "foot"), ("geese", "goose")]
    assert sorted(read_lexicon(spark, os.path.join(d, "lexicon.txt")).collect()) == [("bad", -2.5), ("good", 1.9)]


def test_sorted_predictions(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tidemark-out-"), "p")
    df = spark.createDataFrame([(f"{i:03d}", float(i % 2)) for i in range(200)], "id string, event_type double")
    write_predictions(df.repartition(7), d, sort=True)
    ids = []
    for f in sorted(x for x in os.listdir(d) if x.startswith("part-")):
        with open(os.path.join(d, f)) as fh:
            ids += [line.split(",")[0] for line in fh.read().splitlines()[1:]]
    assert ids == sorted(ids) and len(ids) == 200


def test_word_vector_text_source(spark):
    d = tempfile.mkdtemp(prefix="tidemark-vec-")
    p = os.path.join(d, "v.txt")
    with open(p, "w") as f:
        f.write("goal 0.1 0.2\nmatch -1 2.5\nodd 1\n")
    with pytest.warns(UserWarning, match="1 lines"):
        got = {r.word: r.vec for r in read_word_vectors(spark, p, dim=2).collect()}
    assert got == {"goal": [0.1, 0.2], "match": [-1.0, 2.5]}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"id", "event_type", "labelled"}


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    scols = df.columns
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)

    def rows(recs, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)
    assert rows(df.collect(), scols) == rows(res.fetchall(), dcols)


def test_dictionary_and_term_sources(spark):
    from tidemark.sources.io import materialize, read_frequency_dictionary, read_terms
    d = tempfile.mkdtemp(prefix="tidemark-res-")
    with open(os.path.join(d, "dict.txt"), "w") as f:
        f.write("the 23135851162\nof 13151942776\ngoal 1200\nbad-line\n")
    with open(os.path.join(d, "stop.txt"), "w") as f:
        f.write("the\n  of \n\nthe\n")
    got = dict(read_frequency_dictionary(spark, os.path.join(d, "dict.txt")).collect())
    assert got == {"the": 23135851162, "of": 13151942776, "goal": 1200}
    terms = sorted(r.token for r in read_terms(spark, os.path.join(d, "stop.txt")).collect())
    assert terms == ["of", "the"]
    df = spark.createDataFrame([(1, ""), (2, None)], "k long, s string")
    back = {r.k: r.s for r in materialize(df, "roundtrip").collect()}
    assert back == {1: "", 2: None}      # parquet keeps '' apart from NULL


def test_records_across_splits_equal_the_multi_line_reader(spark, tmp_path):
    """Quotes, line breaks of both kinds, delimiters and empty lines, cut into splits of a few dozen bytes."""
    import random

    from tidemark.sources.csv_records import csv_records
    from tidemark.sources.io import SCORE_CSV_COLUMNS, header_schema
    rng = random.Random(4)
    for name, end in (("a.csv", "\n"), ("b+ c.csv", "\r\n")):
        lines = [",".join(SCORE_CSV_COLUMNS) if name[0] == "a" else '"ID","MatchID",PeriodID,Timestamp,"Tweet"']
        for i in range(120):
            text = "".join(rng.choice(["x", "yz", ",", '""', "\n", "\r\n", " ", "é", "\n\n"]) for _ in range(rng.randrange(12)))
            lines.append(f'{i},{name[0]},{i % 7},{i},' + (f'"{text}"' if text.strip() or rng.random() < 0.5 else ""))
            if rng.random() < 0.1:
                lines.append("")
        (tmp_path / name).write_bytes(end.join(lines).encode() + (b"" if name[0] == "a" else end.encode()))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "37b")
    try:
        records, headers = csv_records(spark, str(tmp_path))
        assert records.select("file", "block").distinct().count() > 100 and {r.header for r in headers.collect()} == {
            ",".join(SCORE_CSV_COLUMNS), '"ID","MatchID",PeriodID,Timestamp,"Tweet"'}
        got = sorted((r.match_id, r.ts, r.id, r.period_id, r.text, r.source_file) for r in read_posts(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set(key, before)
    want = sorted((r.MatchID, r.Timestamp, r.ID, r.PeriodID, r.Tweet, r.n) for r in spark.read.schema(
        header_schema(list(SCORE_CSV_COLUMNS))).option("header", True).option("multiLine", True).option("escape", '"').csv(
        str(tmp_path)).selectExpr("*", "_metadata.file_name AS n").collect())
    assert [g[:4] for g in got] == [w[:4] for w in want] and len(got) == 240
    # The multi-line reader turns every line break of a file into \n; the records keep those inside quotes.
    assert [g[4] and g[4].replace("\r\n", "\n") for g in got] == [w[4] and w[4].replace("\r\n", "\n") for w in want]
    assert {g[5] for g in got} == {"a.csv", "b+ c.csv"}


def test_records_that_do_not_fit_fail(spark):
    d = tempfile.mkdtemp(prefix="tidemark-csv-")
    _csv(d, "Bad.csv", "ID,MatchID,PeriodID,Timestamp,Tweet", "1,1,x,1,a")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_posts(spark, d).collect()
    one = tempfile.mkdtemp(prefix="tidemark-csv-")
    _csv(one, "Head.csv", '"ID","Match\nID",MatchID,PeriodID,Timestamp,Tweet', "1,z,7,2,3,a")
    assert [(r.id, r.match_id, r.text) for r in read_posts(spark, one).collect()] == [("1", "7", "a")]
    empty = tempfile.mkdtemp(prefix="tidemark-csv-")
    _csv(empty, "Only.csv", "ID,MatchID,PeriodID,Timestamp,Tweet")
    assert read_posts(spark, empty).count() == 0
