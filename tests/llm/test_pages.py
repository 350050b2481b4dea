"""WARC archives and URL rules."""

import base64
import gzip
import hashlib

import pytest

from opinara.llm import url_filter, warc
from opinara.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, key string, id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


ROWS = [
    (1, "http://A.example.org/x?q=1", "<p>é</p>"),
    (2, "https://b.example.org/y", "<p>é</p>"),
    (7, "http://a.example.org/x?q=1", "<p>é</p>"),
    (3, "http://c.org/long", "long\r\n\r\nWARC/1.1 " * 30_000),
    (4, None, None),
    (5, "no scheme", ""),
    (6, "http://c.org/tab\there and space", "once"),
    (None, "http://c.org/null", "<p>é</p>"),
    (8, "http://c.org/twice", "t"),
    (8, "http://c.org/twice", "t"),
]


def read_all(spark, frame):
    collection = warc.write(frame)
    keys = frame.select("page_id", "url").mapInArrow(warc.page_keys, "key string")
    return collection, warc.read(collection, warc.lookup(collection, keys))


@pytest.mark.parametrize("lines", [1, 512])
def test_round_trip(spark, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 3)
    _, records = read_all(spark, pages(spark, ROWS).repartition(2))
    got = sorted(
        ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records.collect()),
        key=str,
    )
    want = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        largest = max((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None))
        shared = sum((h or "") == (html or "") for _, _, h in ROWS) > 1
        revisit = shared and page is not None and page < largest
        want.append(
            (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "revisit" if revisit else "response", largest if revisit else None)
        )
    assert got == sorted(want, key=str)
    texts = {r["page_id"]: r["html"] for r in records.collect() if r["record_type"] == "response"}
    assert texts[3] == ROWS[3][2] and texts[6] == "once"


def test_archives_are_gzip_members(spark):
    collection, _ = read_all(spark, pages(spark, ROWS))
    kinds = []
    for row in collection.archives.collect():
        whole = gzip.decompress(bytes(row["content"]))
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
        for capture in row["captures"]:
            place = slice(capture["offset"], capture["offset"] + capture["length"])
            headers, http, payload = warc.parse(bytes(row["content"])[place])
            kinds.append(headers["WARC-Type"])
            if headers["WARC-Type"] == "response":
                assert len(payload) == int(http["Content-Length"])
    assert len(kinds) == len(ROWS)


def test_lookup_of_some_urls(spark):
    rows = [(i, f"http://h{i % 7}.example.org/{i % 300}", f"page {i}") for i in range(1000)]
    collection, _ = read_all(spark, pages(spark, rows))
    wanted = [rows[5][1], rows[299][1], "http://nowhere.net/"]
    keys = spark.createDataFrame([(warc.url_key(u),) for u in wanted], "key string")
    got = warc.read(collection, warc.lookup(collection, keys)).collect()
    assert sorted(r["html"] for r in got) == sorted(h for _, u, h in rows if u in wanted)


@pytest.mark.parametrize("keys_per_task", [1, 250_000])
def test_only_blocks_of_wanted_keys_are_unpacked(spark, monkeypatch, keys_per_task):
    monkeypatch.setattr(warc, "KEYS_PER_TASK", keys_per_task)
    rows = [(i, f"http://h{i:04d}.org/", f"page {i}") for i in range(8000)]
    rows += [(9000 + i, "http://hot.org/", f"hot {i}") for i in range(1500)]
    collection = warc.write(pages(spark, rows))
    names = ["http://h0005.org/", "http://h7999.org/", "http://hot.org/", "http://hot.org/absent", "http://a.net/"]
    keys = [(warc.url_key(u),) for u in names * 2] + [(None,)]
    wanted = spark.createDataFrame(keys, "key string")
    got = warc.lookup(collection, wanted)
    assert got.count() == 1502
    assert sorted(r["html"] for r in warc.read(collection, got).collect()) == sorted(
        [rows[5][2], rows[7999][2], *(h for _, u, h in rows if u == "http://hot.org/")]
    )
    lines = collection.index.collect()
    inside = sum(any(b["first"] <= k <= b["last"] for (k,) in keys if k) for b in lines)
    parts = collection.parts.collect()
    assigned = [
        (k, p["part"]) for k in {k for (k,) in keys if k} for p in parts if p["first"] <= k <= p["last"]
    ]
    frame = spark.createDataFrame(assigned, "key string, part int")
    assert warc.wanted_blocks(collection, frame).count() == inside < len(lines) / 2


@pytest.mark.parametrize("lines, size", [(20, 1), (20, 1 << 30)])
def test_parts_and_reading_tasks_follow_the_input(spark, monkeypatch, lines, size):
    monkeypatch.setattr(warc, "PART_LINES", lines)
    monkeypatch.setattr(warc, "READ_BYTES", size)
    monkeypatch.setattr(warc, "READ_TASKS", 5)
    rows = [(i, f"http://h{i}.org/", f"page {i}") for i in range(600)]
    collection, records = read_all(spark, pages(spark, rows))
    assert collection.parts.count() > 20
    assert sorted(r["html"] for r in records.collect()) == sorted(h for _, _, h in rows)


def test_least_payload_and_empty_table(spark):
    frame = pages(spark, [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, "http://c/", "s"), (4, "http://d/", "s")])
    collection = warc.write(frame, least=3)
    keys = frame.select("page_id", "url").mapInArrow(warc.page_keys, "key string")
    kinds = {r["page_id"]: r["record_type"] for r in warc.read(collection, warc.lookup(collection, keys)).collect()}
    assert kinds == {1: "revisit", 2: "response", 3: "response", 4: "response"}
    assert read_all(spark, frame.limit(0))[1].count() == 0


def test_url_keys():
    assert warc.url_key("http://www.Example.org/a?b#c") == "org,example,www)/a?b#c"
    assert warc.url_key("no scheme") == "no scheme"


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.B.Example.ORG/en/17?x", "a.b.example.org", "/en/17", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("https://x.com/de/#t", "x.com", "/de/", "com/de/", "block"),
        ("https://x.com/en/", "x.com", "/en/", None, "allow"),
        ("https://com?de", "com", "", None, "allow"),
        ("x.com/de/", "", "", None, "allow"),
        ("a://b://com/de/", "b:", "//com/de/", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    row = url_filter.judge(pages(spark, [(1, url, None)]), URL_RULES).first()
    assert tuple(row) == (1, host, path, rule, verdict)


def canonical(url):
    return f'<LINK href="{url}" rel="canonical"/>'


def test_decisions_reach_aliases(spark):
    rows = [
        (1, "http://a.net/1", canonical("http://x.com/de/1")),  # alias of a blocked url
        (2, "https://a.net/1#part", ""),  # the same node
        (3, "http://b.net/x/1", "<meta http-equiv=refresh content='0; url=/x/2'>"),
        (4, "http://b.net/x/2", canonical("//x.com/de/2")),
        (5, "http://c.net/1", canonical("http://x.com/de/3")),
        (6, "http://c.net/2", canonical("http://c.net/1")),
        (7, "http://good.org/", canonical("http://c.net/2")),  # an allowed url in the class
        (8, "http://d.net/1", canonical("2")),  # nothing decided
        (9, "http://x.com/de/3", ""),  # its own rule stays
        (10, "http://e.net/", ""),
        (11, "http://e.net/", "<meta name='canonical'><link rel=stylesheet href=http://x.com/de/>"),
    ]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages(spark, rows), URL_RULES).collect()}
    blocked = {1, 2, 3, 4, 9}
    assert got == {i: "block" if i in blocked else "allow" for i, *_ in rows}
    redirects = spark.createDataFrame([("http://e.net/", "http://x.com/de/9")], "source string, target string")
    more = url_filter.judge(pages(spark, rows), URL_RULES, redirects)
    assert {r["page_id"] for r in more.collect() if r["verdict"] == "block"} == blocked | {10, 11}


def test_entities_in_link_targets(spark):
    rows = [
        (1, "http://a.net/1", canonical("http://x.com/de/?a=1&amp;b=2")),  # a blocked url
        (2, "http://a.net/2?c=1&d=2", ""),
        (3, "http://a.net/1", "<meta http-equiv=refresh content='0; url=/2?c=1&#38;d=2'>"),
        (4, "http://b.net/?a=1&amp;b", canonical("http://x.com/de/?&quot;")),  # the page's own url stays
        (5, "http://b.net/?a=1&b", ""),
        (6, "http://c.net/?&lt;", canonical("http://x.com/de/?x")),
        (7, "http://d.net/", canonical("http://c.net/?&amp;lt;")),  # unescaped once
    ]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages(spark, rows), URL_RULES).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 3, 4, 6, 7}


TARGETS = [
    ("?a=1", "http://s.net/d/p?a=1"),
    ("#part", None),
    ("", None),
    ("q", "http://s.net/d/q"),
    ("../q", "http://s.net/q"),
    ("../../../q/./r/..", "http://s.net/q/"),
    ("./", "http://s.net/d/"),
    ("/a/../b/.", "http://s.net/b/"),
    ("..a/b..", "http://s.net/d/..a/b.."),
    ("mailto:x@s.net", None),
    ("javascript:f()", None),
    ("HTTPS://t.net/a/../b?../c", "HTTPS://t.net/b?../c"),
    ("//t.net", "http://t.net"),
    (" /two words\n", "http://s.net/two words"),
    ("it's", "http://s.net/d/it's"),
]


def test_targets_of_every_kind(spark):
    rows = [(i, "http://s.net/d/p?x=1#y", canonical(t)) for i, (t, _) in enumerate(TARGETS)]
    frame = pages(spark, rows)
    got = [r["target"] for r in url_filter.link_edges(frame.coalesce(1)).collect()]
    assert got == [w for _, w in TARGETS if w]
    tags = [
        "<link data-href='/no' rel=canonical href='/yes'>",
        "<link data-rel=canonical href='/no'>",
        "<link rel='canonical' href=/yes>",
        "<meta http-equiv=refresh content='3; URL=\"/y es\"'>",
        '<meta content="0;url=&#39;/yes&#39;" http-equiv="Refresh">',
        "<meta http-equiv=refresh content=5>",
        "<meta http-equiv=refresh content=5;url=/yes>",
    ]
    frame = pages(spark, [(1, "http://s.net", "".join(tags) + "x" * 2_000_000)])
    got = [r["target"] for r in url_filter.link_edges(frame).collect()]
    assert got == [f"http://s.net/{x}" for x in ("yes", "yes", "y es", "yes", "yes")]


def test_repeated_ids_with_other_urls(spark):
    rows = [(1, "http://x.com/de/1", ""), (1, "http://y.net/", ""), (1, "http://y.net/", "")]
    got = sorted(r["verdict"] for r in url_filter.judge(pages(spark, rows), URL_RULES).collect())
    assert got == ["allow", "allow", "block"]


def test_the_sql_knows_the_links_too(spark):
    import duckdb

    from opinara.llm.sql import ORACLE

    rows = [
        (1, "http://a.net/1", canonical("http://x.com/de/1")),
        (3, "http://b.net/x/1", "<meta http-equiv=refresh content='0; url=2'>"),
        (4, "http://b.net/x/2", canonical("//x.com/de/2")),
        (5, "http://c.net/1", canonical("http://x.com/de/3")),
        (7, "http://good.org/", canonical("http://c.net/1")),
        (8, None, None),
        (9, "http://p.net/d/p", canonical("../q")),
        (10, "http://p.net/q", canonical("http://x.com/de/./5?a=1&amp;b")),
        (11, "http://p.net/r", "<meta http-equiv=refresh content='0; url=\"?a\"'>"),
        (12, "http://p.net/r?a", canonical("http://x.com/fr/../de/6")),
        (13, "http://p.net/m", canonical("mailto:x")),
        (14, "http://p.net/", canonical("#q")),
    ]
    rows += [(100 + i, f"http://s{i}.net/d/p", canonical(t)) for i, (t, _) in enumerate(TARGETS)]
    rows += [(200 + i, w.replace("s.net", f"s{i}.net"), canonical("http://x.com/de/9"))
             for i, (_, w) in enumerate(TARGETS) if w]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    got = url_filter.judge(pages(spark, rows), URL_RULES).select("host", "page_id", "path", "rule", "verdict")
    want = connection.execute(f"SELECT host, page_id, path, rule, verdict FROM ({ORACLE['op5_url_filter']})")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_no_pages_and_bad_rules(spark):
    assert url_filter.judge(pages(spark, []), URL_RULES).count() == 0
    assert url_filter.judge(pages(spark, [(1, "http://a.org/", "")]), []).first()["verdict"] == "allow"
    with pytest.raises(ValueError):
        url_filter.judge(pages(spark, []), [("maybe", "org/")])
