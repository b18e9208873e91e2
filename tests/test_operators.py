"""Rules at their thresholds, parsers on hand-made pages, the queue's transitions, readers, sinks and the stream."""

import json

import pytest
from pyspark.sql import functions as F
from tallyspark.functions import text
from tallyspark.operators import derive, relations, work_queue
from tallyspark.plans import report
from tallyspark.sources import markup, readers
from tallyspark.streaming import queue_stream


@pytest.mark.parametrize(("name", "exposure", "subs", "favs", "want"), [
    ("x", 80, 10, 1, 1), ("x", 81, 10, 1, 0), ("x", 80, 11, 1, 0), ("my test", 1999, 50, 19, 1), ("my test", 1999, 51, 19, 0), ("my test", 2000, 5, 1, 0),
    ("contest", 500, 20, 5, 0), ("TEST", 500, 20, 5, 1), ("自用", 500, 20, 5, 1), ("étest", 500, 20, 5, 0), ("x", 0, 100, 0, 0), ("x", 0, 0, 20, 0)])
def test_private_like(spark, name, exposure, subs, favs, want):
    df = spark.createDataFrame([(name, exposure, subs, favs)], "n string, e long, s long, f long")
    assert df.select(derive.private_like(F.col("n"), F.col("e"), F.col("s"), F.col("f"))).first()[0] == want


def test_list_page(spark):
    hover = [{"id": "11", "title": 'a "q" {', "description": "x}"}, {"id": "zz", "title": "no"}, {"id": "13", "title": "c"}]
    scripts = "".join(f"{markup.HOVER}(1, {json.dumps(h)});" for h in hover[:1]) + f"{markup.HOVER}(2, {{broken);}}" + "".join(f"{markup.HOVER}(1, {json.dumps(h)});" for h in hover[1:])
    items = "".join(f'<img class="fileRating" src="/i/{n}-star.png?x=1"><a class="workshop_author_link" href="#">By A&amp;{n}</a>' for n in (3, 4, 5))
    page = f'var paramsGET = {{"requiredtags":["Trade"]}};<p class="workshopBrowsePagingInfo">Showing 1,031-60 of</p><div {markup.ITEMS_FROM}>{items}</div><div {markup.ITEMS_TO}>' + scripts
    empty = 'var paramsGET = {"requiredtags":[]};'
    got = markup.list_rows(spark.createDataFrame([(1, page), (2, empty)], "p int, h string"), "p", "h", "u?id=").orderBy("rank").collect()
    assert [(r["tag"], r["rank"], r["item_id"], r["star_rating"], r["author"]) for r in got] == [("Trade", 1031, "11", "3-star", "A&3"), ("Trade", 1033, "13", "5-star", "A&5")]
    tags = spark.createDataFrame([(page,), (empty,), ("",)], "h string").select(markup.page_tag(F.col("h"))).collect()
    assert [r[0] for r in tags] == ["Trade", markup.NO_TAG, None]


def test_detail_and_hub_pages(spark):
    page = ("var publishedfileid = '42';<div class=\"workshopItemTitle\">A &lt;b&gt;\nc</div><tr><td>1,234</td><td>Unique Visitors</td></tr>"
            '<tr><td>12</td><td>Current Subscribers</td></tr><a href="?requiredtags%5B%5D=x">fix</a><a href="?requiredtags%5B%5D=y">no such</a>')
    got = markup.detail_rows(spark.createDataFrame([(page,), ("<p>no id</p>",)], "h string"), "h").collect()
    assert [tuple(r) for r in got] == [("42", "A <b> c", 1234, 12, 0, ["Fixes"])]
    hub = ('<input type=x name="appid" value="77"><div class="a filterOption b"><input name="requiredtags[]" value="New+Nations"><label class="tag_label">New Nations <span class="tag_count">(1,234)</span></label></div>'
           "See all 16,244 Items See all 3 Items")
    r = markup.hub_row(spark.createDataFrame([(hub, "")], "h string, u string"), "h", "u").first()
    assert (r["app_id"], r["items"], [tuple(t) for t in r["tags"]]) == (77, 16244, [("New Nations", 1234)])
    states = spark.createDataFrame([(None,), ("",), ("x",), (markup.ITEMS_FROM,)], "h string").select(markup.page_status(F.col("h"))).collect()
    assert [s[0] for s in states] == ["missing", "empty", "invalid", "ok"]


def test_text(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    s = F.lit
    assert one(text.loose_int(s("1 234,5'6"))) == 123456 and one(text.loose_int(s(""))) == 0 and one(text.strict_int(s("16.244"))) == 16244
    assert [one(text.number_text(s(x))) for x in (1234.5, 2.5, 0.25, 100.0, float("nan"))] == ["1,234.50", "2.5", "0.25", "100", "NaN"]
    assert one(text.form_encode(s("a b*~é"))) == "a+b%2A~%C3%A9" and one(text.bar(s(0.5), 4)) == "██░░" and one(text.query_id(s("u?a=1&id=9"))) == "9"
    now = F.to_timestamp(s("2026-01-01 00:00:00"))
    waits = [one(text.retry_after(s(h), now, s(2))) for h in ("7", "0", "Thu, 01 Jan 2026 00:01:00 GMT", "soon")]
    assert waits == [7.0, 1.0, 60.0, 60.0]
    with pytest.raises(Exception, match="not an integer"):
        one(text.strict_int(s("x1")))


def test_queue(spark):
    state = spark.createDataFrame([(i, f"u{i}", st, r) for i, (st, r) in enumerate([("pending", 0), ("fail", 0), ("fail", 2), ("fail", 3), ("invalid", 0), ("success", 0)])], "id long, url string, status string, retry_count int")
    results = spark.createDataFrame([(0, True, 200), (1, False, 404), (2, False, 500)], "id long, ok boolean, status_code int")
    got = {gap: {r["id"]: (r["status"], r["retry_count"]) for r in work_queue.step(state, results, gap).collect()} for gap in (True, False)}
    assert got[True][2] == ("fail", 3) and got[False][2] == ("fail", 0) and got[True][0] == ("success", 0) and got[True][1] == ("invalid", 0) and got[True][3] == ("fail", 3)
    rest = state.where("id > 0")
    assert [tuple(work_queue.phase(x, 3).first()) for x in (state, rest, state.where("id > 2"))] == [("full", 1, None), ("gap", 2, 0), ("terminal", 0, None)]
    assert [r["id"] for r in work_queue.pick(state, 3, 5).collect()] == [0] and [r["id"] for r in work_queue.pick(rest, 3, 5).collect()] == [1, 2]
    assert work_queue.checked_count(state, 2).count() == 6
    with pytest.raises(Exception, match="do not match"):
        work_queue.checked_count(state, 5).count()
    votes = spark.createDataFrame([(a, b) for a in (0, 1, 2) for b in (0, 1, 2)], "a int, b int").select(work_queue.consensus(F.col("a"), F.col("b"))).collect()
    assert [v[0] for v in votes] == [0, 2, 0, 2, 1, 1, 0, 1, 2]


def test_runs_and_grades(spark):
    cases = {1: "ooooo", 2: "xxxxx", 3: "oxxxoooooo", 4: "oooxx", 5: "oxxxxxo"}
    rows = [(p, i, c == "o", c == "x", False, 1.0) for p, s in cases.items() for i, c in enumerate(s)]
    df = spark.createDataFrame(rows, "port int, i int, ok boolean, bad boolean, lim boolean, v double")
    g = {r["port"]: (r["longest"], r["grade"]) for r in work_queue.grades(df, "port", "i", F.col("ok"), F.col("bad"), F.col("lim"), F.col("v")).collect()}
    assert g == {1: (0, "A"), 2: (5, "F"), 3: (3, "C"), 4: (2, "B"), 5: (5, "C")}
    last = work_queue.breaker(df, "port", "i", F.col("bad")).where("port = 5").orderBy("i").collect()
    assert [r["state"] for r in last] == ["healthy", "healthy", "degraded", "degraded", "degraded", "quarantined", "healthy"]


def test_stream_follows_batches(spark, tmp_path):
    state = spark.createDataFrame([(i, f"u{i}", "pending", 0) for i in range(4)], "id long, url string, status string, retry_count int")
    queue_stream.begin(state, f"{tmp_path}/state")
    spark.createDataFrame([(0, True, 200, 1), (1, False, 500, 1), (1, True, 200, 2)], "id long, ok boolean, status_code int, seq long").write.parquet(f"{tmp_path}/results")
    results = spark.readStream.schema("id long, ok boolean, status_code int, seq long").parquet(f"{tmp_path}/results")
    queue_stream.follow(results, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    now = lambda n=9: {r["id"]: r["status"] for r in queue_stream.current(spark, f"{tmp_path}/state", n).collect()}
    assert now() == {0: "success", 1: "success", 2: "pending", 3: "pending"} and set(now(0).values()) == {"pending"}
    spark.createDataFrame([(2, False, 404, 3)], "id long, ok boolean, status_code int, seq long").write.mode("append").parquet(f"{tmp_path}/results")
    queue_stream.follow(results, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    assert now() == {0: "success", 1: "success", 2: "invalid", 3: "pending"}
    for seq, code in ((4, 500), (5, 404), (6, 500)):
        spark.createDataFrame([(0, False, code, seq)], "id long, ok boolean, status_code int, seq long").write.mode("append").parquet(f"{tmp_path}/results")
        queue_stream.follow(results, f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    assert now() == {0: "fail", 1: "success", 2: "invalid", 3: "pending"}
    assert max(len(list(b.glob("version=*"))) for b in (tmp_path / "state").glob("bucket=*")) == 2


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a" / "00").mkdir(parents=True)
    (tmp_path / "a" / "00" / "000012.html").write_bytes(b"<p>\xff</p>")
    assert [(r["row_id"], "�" in r["html"]) for r in readers.pages(spark, str(tmp_path / "a")).collect()] == [(12, True)]
    (tmp_path / "u.json").write_text('["x", "y"]')
    assert [tuple(r) for r in readers.url_list(spark, str(tmp_path / "u.json")).collect()] == [(1, "x"), (2, "y")]
    (tmp_path / "b.json").write_text('["x", " "]')
    with pytest.raises(Exception, match="blank url"):
        readers.url_list(spark, str(tmp_path / "b.json")).collect()
    (tmp_path / "i.json").write_text('{"ids": ["1", "a", "22"]}')
    assert [r["url"] for r in readers.id_list(spark, str(tmp_path / "i.json"), "u/").collect()] == ["u/1", "u/22"]
    (tmp_path / "s.csv").write_text("a,1.5,2\nb,x\n3\n")
    assert [r[0] for r in readers.series(spark, str(tmp_path / "s.csv")).collect()] == [1.5, 3.0]
    r = spark.createDataFrame([(1, 0.5, 0), (2, 0.9, 1)], "mod_id long, ratio double, tier int")
    report.write_tiers(r, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("tier = 1").count() == 1
    urls = spark.createDataFrame([(2, "b"), (1, "a"), (3, " ")], "i int, u string")
    lines = report.url_document(urls, "i", "u")
    assert sorted(tuple(r) for r in lines.collect()) == [(1, '"a"'), (2, '"b"')]
    report.write_lines(lines, f"{tmp_path}/lines")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/lines").collect()] == ['"a"', '"b"']
    status = relations.coverage(spark.range(3).toDF("k"), spark.createDataFrame([(1, True), (2, False), (9, True)], "k long, o boolean"), "k", F.col("o"))
    assert sorted((tuple(r) for r in report.gap_document(status, "k").collect()), key=str) == [("extra", 9, "extra"), ("gap", 0, "missing"), ("gap", 2, "invalid"), ("gap_count", 2, None), ("url_count", 3, None)]
