import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.sources import landing

RUN = datetime(2025, 6, 1)


def _read(spark, tmp_path, lines, schema):
    path = tmp_path / "landed.json"
    path.write_text("\n".join(json.dumps(line) for line in lines))
    return landing.read_payload(spark, str(path), schema)


def _hit(i, **fields):
    return {"objectID": i, "created_at": "2024-01-02T00:00:00Z", **fields}


def test_search_hits(spark, tmp_path):
    page = {"query_tool": "Claude", "hits": [
        _hit("1", title="T", story_text="S", points=3),
        _hit("2", title="T", comment_text="C", story_text="S"),
        _hit("3", title="T", comment_text="", story_text=""),
        _hit("4", title="T", comment_text=None),
    ]}
    rows = landing.hn_rows(_read(spark, tmp_path, [page, {"query_tool": "v0", "hits": []}], schemas.HN_PAGE), RUN)
    schemas.validate_frame(rows, schemas.HN_RAW)
    got = [(r.object_id, r.text, r.object_type, r.query_tool, r.points) for r in rows.orderBy("object_id").collect()]
    assert got == [
        ("1", "S", "story", "Claude", 3), ("2", "C", "comment", "Claude", None),
        ("3", "T", "story", "Claude", None), ("4", "T", "story", "Claude", None),
    ]


def test_submissions(spark, tmp_path):
    lines = [
        {"query_tool": "v0", "id": "a", "subreddit": "webdev", "title": "t", "selftext": "", "author": "u",
         "permalink": "/r/webdev/a", "created_utc": 1704067200.0, "score": 1, "num_comments": 0},
        {"query_tool": "v0", "id": "b", "subreddit": "webdev", "title": "t", "author": None, "permalink": "/r/b", "created_utc": 1.5},
    ]
    rows = landing.reddit_rows(_read(spark, tmp_path, lines, schemas.REDDIT_SUBMISSION), RUN)
    schemas.validate_frame(rows, schemas.REDDIT_RAW)
    a, b = rows.orderBy("object_id").collect()
    assert (a.permalink, a.author, a.reddit_created_utc) == ("https://reddit.com/r/webdev/a", "u", datetime(2024, 1, 1))
    assert (b.author, b.object_type, b.reddit_created_utc) == (None, "submission", datetime(1970, 1, 1, 0, 0, 1, 500000))


def _post(i, created, comments=None, **fields):
    return {"node": {"id": i, "name": f"n{i}", "url": f"u{i}", "createdAt": created, "comments": comments, **fields}}


def _comments(*bodies):
    return {"edges": [{"node": {"id": b, "body": b, "createdAt": "2024-05-01T00:00:00Z", "user": u}} for b, u in bodies]}


@pytest.fixture
def pages(spark, tmp_path):
    edges = [
        _post("1", "2024-01-03T00:00:00Z", _comments(("c1", {"username": "x"}), ("c2", None)), tagline=" tag", description="d\n"),
        _post("2", "2024-01-02T00:00:00Z", None, tagline=None, description="d"),
        _post("3", None, {"edges": None}, tagline="t", votesCount=4, commentsCount=0),
        _post("4", "2024-01-01T00:00:00Z", _comments(("c4", {"username": None}))),
    ]
    page = {"data": {"posts": {"edges": edges, "pageInfo": {"hasNextPage": False, "endCursor": None}}}}
    return _read(spark, tmp_path, [page, {"data": {"posts": {"edges": []}}}], schemas.PH_PAGE)


def test_posts_and_comments(pages):
    rows = landing.producthunt_rows(landing.producthunt_posts(pages), RUN)
    schemas.validate_frame(rows, schemas.PRODUCTHUNT_RAW)
    got = {r.object_id: (r.title, r.text, r.author, r.object_type, r.votes_count) for r in rows.collect()}
    assert got == {
        "1": ("n1", "tag d", None, "post", None),
        "c1": ("n1", "c1", "x", "comment", None),
        "c2": ("n1", "c2", None, "comment", None),
        "2": ("n2", "d", None, "post", None),
        "3": ("n3", "t", None, "post", 4),
        "4": ("n4", "", None, "post", None),
        "c4": ("n4", "c4", None, "comment", None),
    }


def test_post_cutoff(pages):
    """At the mark: out, with comments. Undated: in. Comments are not tested."""
    posts = landing.producthunt_new(landing.producthunt_posts(pages), datetime(2024, 1, 1))
    assert {r.object_id for r in landing.producthunt_rows(posts, RUN).collect()} == {"1", "c1", "c2", "2", "3"}


def test_cutoff_per_search_term(spark):
    rows = [("1", "A", "2024-01-02T00:00:00Z"), ("2", "A", "2024-01-01T00:00:00Z"), ("3", "B", "2024-01-01T00:00:00Z"), ("4", "A", None)]
    df = spark.createDataFrame(rows, "object_id string, query_tool string, hn_created_at string")
    marks = spark.createDataFrame([("A", datetime(2024, 1, 1))], "query_tool string, mark timestamp")
    assert {r.object_id for r in landing.hn_new(df, marks).collect()} == {"1", "3"}
    assert landing.hn_new(df, None).count() == 4


def test_payload_stream_reads_the_same(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"query_tool": "v0", "hits": [_hit("1", title="T")]}))
    stream = landing.hn_rows(landing.stream_payload(spark, str(tmp_path / "in"), schemas.HN_PAGE), RUN)
    out = str(tmp_path / "out")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(out).select("object_id", "text").collect() == [("1", "T")]


def test_no_date_is_null_not_an_error(spark):
    from mentionkit.functions.times import iso_to_epoch, parse_iso

    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00.5+02:00",), ("soon",), (None,)], "t string")
    got = df.select(parse_iso(F.col("t")), iso_to_epoch(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        (datetime(2024, 1, 1), 1704067200), (datetime(2023, 12, 31, 22, 0, 0, 500000), 1704060000), (None, None), (None, None),
    ]


def test_lines_that_are_no_payload(spark, tmp_path):
    good = json.dumps({"query_tool": "v0", "id": "a", "score": 3})
    bad = ["{\"query_tool\": \"v0\"", "plain words", "[1, 2]", "null", "7", json.dumps({"id": "b", "score": "many"})]
    path = tmp_path / "landed.json"
    path.write_text("\n".join([good, "", "  \t", *bad, good]))
    read = landing.read_payload(spark, str(path), schemas.REDDIT_SUBMISSION)
    rows = landing.rejected_lines(read, "reddit", RUN).collect()
    assert sorted(r["line"] for r in rows) == sorted(bad)
    assert {r["source"] for r in rows} == {"reddit"} and all(r["file"].endswith("landed.json") for r in rows)
    # nothing of a rejected line is taken in part
    assert [(r["id"], r["score"]) for r in read.collect() if r["id"] is not None] == [("a", 3)] * 2
    assert landing.rejected_lines(read.select("id"), "reddit") is None


def test_rejected_submissions_give_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "a"}\nbroken')
    read = landing.read_payload(spark, str(tmp_path), schemas.REDDIT_SUBMISSION)
    assert [r["object_id"] for r in landing.reddit_rows(read, RUN).collect()] == ["a"]
    assert landing.payloads(read).columns == schemas.REDDIT_SUBMISSION.names
