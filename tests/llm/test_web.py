import base64
import gzip
import hashlib
import re

import pytest

from lexloom.llm import decontaminate, urlrules, warc
from lexloom.llm.queries import URL_RULES
from lexloom.llm.storage import read_file
from tests.llm.conftest import ODD_TEXTS


def pages_of(spark):
    rows = [(k, f"http://h.example/{k}?q=ü x", t, 1, "x") for k, t in enumerate(ODD_TEXTS)]
    rows += [(50, None, "a", 1, "x"), (40, "bad\r\nurl: x", "a", 1, "x"), (7, "http://h.example/7", ODD_TEXTS[7], 1, "x"), (None, "http://n/", "a", 1, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, place long, file string")


def resolved_by_hand(rows, least):
    first = {}
    for i, t in sorted((i, t) for i, t in rows if i is not None):
        first.setdefault(t, i)
    return {i: None if len(t) < least or first[t] == i else first[t] for i, t in rows if i is not None and i != 7}


def test_archives_hold_each_payload_once(spark):
    pages = pages_of(spark)
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    for least in (0, 30):
        stored = warc.resolve_revisits(warc.write_archives(pages.repartition(3)), least)
        found = warc.read_archives(stored, payloads=True).collect()
        assert len(found) == len(rows) and sum(r.records for r in stored.collect()) == len(rows)
        want = resolved_by_hand(rows, least)
        payloads = dict(rows)
        for r in found:
            payload = payloads[r.row_id]
            assert r.payload_bytes == len(payload) and r.digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if r.row_id in want:
                assert (r.record_type, r.refers_to) == (("response", None) if want[r.row_id] is None else ("revisit", want[r.row_id]))
            assert (bytes(r.payload) == payload) if r.record_type == "response" else (r.payload is None)
        assert sorted(r.record_type for r in found if r.row_id == 7) == (["response"] * 2 if len(payloads[7]) < least else ["revisit"] * 2)
        # A second resolution finds every original again.
        again = warc.read_archives(warc.resolve_revisits(stored, least)).collect()
        key = lambda r: (str(r.row_id), r.record_type, str(r.refers_to))
        assert sorted(map(key, again)) == sorted(map(key, found))


def test_records_are_plain_gzip_members(spark):
    stored = warc.write_archives(pages_of(spark)).collect()
    text = b"".join(gzip.decompress(read_file(r.file)) for r in stored)
    assert text.count(b"WARC/1.1\r\n") == sum(r.records for r in stored)
    assert b"\r\nurl" not in text and text.count(b"WARC-Payload-Digest: sha1:") == sum(r.records for r in stored)


def test_small_archives_and_empty_tables(spark, monkeypatch):
    pages = pages_of(spark)
    assert warc.read_archives(warc.resolve_revisits(warc.write_archives(pages.limit(0)))).count() == 0
    archives = warc._Archives("/nowhere", "x")
    assert list(archives.flush()) == []


def foreign(kind, name, date, block, digest=None, version="WARC/1.0", **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{name}>", "warc-date": date, "Content-Length": len(block), **more}
    if digest:
        fields["WARC-Payload-Digest"] = "sha1:" + digest
    return gzip.compress((version + "\r\n" + "".join(f"{k}:{v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + b"\r\n\r\n")


def test_archives_of_others_keep_dates_heads_and_other_records(spark, tmp_path):
    body, other = b"<html>same</html>", b"\x00binary\xff"
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    head = lambda status, n: f"HTTP/1.1 {status}\r\nServer: x\r\ncontent-length:{n}\r\n\r\n".encode()
    uri = {"WARC-Target-URI": "http://a/", "WARC-IP-Address": "10.0.0.1"}
    records = [
        foreign("warcinfo", "info", "2020-01-01T00:00:00Z", b"software: y\r\n", **{"Content-Type": "application/warc-fields"}),
        foreign("request", "req", "2020-01-01T00:00:01Z", b"GET / HTTP/1.1\r\n\r\n", **uri),
        foreign("response", "late", "2021-05-05T00:00:00Z", head("404 Not Found", len(body)) + body, digest.lower(), **uri),
        foreign("response", "early", "2020-03-03T00:00:00Z", head("200 OK", len(body)) + body, version="WARC/1.1", **uri),
        foreign("revisit", "again", "2022-02-02T00:00:00Z", b"HTTP/1.1 304 Not Modified\r\n\r\n", digest, **uri),
        foreign("revisit", "gone", "2022-02-03T00:00:00Z", head("200 OK", 7), "A" * 32, **uri, **{"WARC-Refers-To": "<urn:uuid:elsewhere>", "WARC-Refers-To-Date": "2010-01-01T00:00:00Z"}),
        foreign("response", "only", "2020-01-04T00:00:00Z", head("200 OK", len(other)) + other, **uri),
        foreign("resource", "res", "2020-01-05T00:00:00Z", b"plain", **uri),
    ]
    path = tmp_path / "foreign.warc.gz"
    path.write_bytes(b"".join(records))
    manifest = spark.createDataFrame([(str(path), len(records), path.stat().st_size)], "file string, records long, bytes long")
    stored = warc.resolve_revisits(manifest)
    found = [warc.parse(content) for r in stored.collect() for _, content in warc.members(r.file)]
    by_id = {f["WARC-Record-ID"][10:-1]: (f, http, payload) for f, http, _, payload in found}
    assert [f["WARC-Record-ID"][10:-1] for f, *_ in found] == ["info", "req", "late", "early", "again", "gone", "only", "res"]
    before = {f["WARC-Record-ID"][10:-1]: (f, http, payload) for f, http, _, payload in (warc.parse(gzip.decompress(r)) for r in records)}
    for name, (fields, http, payload) in by_id.items():
        assert fields["WARC-Date"] == before[name][0]["WARC-Date"] and http == before[name][1]
        assert fields.get("WARC-IP-Address") == before[name][0].get("WARC-IP-Address")
        assert payload == (b"" if name == "late" else before[name][2])
    for name in ("late", "again"):
        fields = by_id[name][0]
        assert fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == "<urn:uuid:early>" and fields["WARC-Refers-To-Date"] == "2020-03-03T00:00:00Z"
    assert by_id["gone"][0]["WARC-Refers-To"] == "<urn:uuid:elsewhere>" and by_id["gone"][0]["WARC-Refers-To-Date"] == "2010-01-01T00:00:00Z"
    assert {n: f["WARC-Type"] for n, (f, *_) in by_id.items()} == {n: "revisit" if n == "late" else f["WARC-Type"] for n, (f, *_) in before.items()}
    rows = {r.record_id[10:-1]: r for r in warc.read_archives(stored, payloads=True).collect()}
    assert rows["early"].payload_bytes == len(body) and rows["again"].payload_bytes is None and rows["res"].payload == b"plain"
    bad = tmp_path / "bad.warc.gz"
    bad.write_bytes(foreign("response", "x", "d", head("200 OK", 1) + b"z", digest, **uri))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark.createDataFrame([(str(bad),)], "file string")).collect()


def test_dates_of_pages(spark):
    pages = spark.sql("SELECT 1L AS page_id, 'http://a/' AS url, 'x' AS html, TIMESTAMP'2024-02-03 04:05:06' AS seen, 'y' AS date")
    stored = warc.resolve_revisits(warc.write_archives(pages, date_column="seen"))
    assert [r.date for r in warc.read_archives(stored).collect()] == ["2024-02-03T04:05:06Z"]


def judged(spark, rows, redirects=None):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, key string, rule string")
    return {r.page_id: r for r in urlrules.judge_urls(pages, URL_RULES, redirects).collect()}


def test_longest_rule_wins(spark):
    urls = ["http://a.example.org/es/1", "HTTP://A.EXAMPLE.ORG/en/12", "http://x.org/", "http://x.org", "http://xcom/fr/", "http://b.com/fr/a#?", "http://b.com/de/", "no url", None, "", "http://É.com/de/x", "https://org?x=/", "http://u://b.com/de/"]
    found = judged(spark, [(k, u, None) for k, u in enumerate(urls)])
    for k, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fit = [(len(r.host + r.path), r.host + r.path, r.action) for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule, verdict = max(fit)[1:] if fit else (None, "allow")
        assert (found[k].host, found[k].path, found[k].rule, found[k].verdict) == (host, path, rule, verdict), url


def test_decisions_reach_aliases_and_allow_comes_first(spark):
    canonical = '<html><LINK href="{}" rel=canonical></html>'
    rows = [
        (1, "http://a.net/x", canonical.format("http://b.com/de/bad")),
        (2, "http://c.net/y#frag", '<meta http-equiv="refresh" content="0; url=//a.net/x">'),
        (3, "http://c.net/y", None),
        (4, "http://d.net/p/q", canonical.format("r?a=1&amp;b=2")),
        (5, "http://d.net/p/r?a=1&b=2", canonical.format("http://z.org/ok")),
        (6, "http://e.net/", canonical.format("http://e.net/#self")),
        (7, "http://d.net/p/q", canonical.format("http://b.com/de/bad2")),
        (8, "http://b.com/de/bad", None),
        (9, "http://f.net/", None),
        (10, "http://y.org/", canonical.format("http://b.com/de/bad")),
    ]
    found = judged(spark, rows, spark.createDataFrame([("http://f.net/", "/relative"), ("http://f.net/", "http://b.com/de/3"), (None, "http://x/")], "source string, target string"))
    verdicts = {k: r.verdict for k, r in found.items()}
    # 10 is allowed by its own rule, and since it is equivalent to 1, 2 and 3 they are too; 8 keeps its own block.
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "block", 10: "allow"}
    without = {k: r.verdict for k, r in judged(spark, rows[:3] + rows[7:8]).items()}
    assert without == {1: "block", 2: "block", 3: "block", 8: "block"}
    assert judged(spark, rows[:0] + [(1, None, canonical.format("http://b.com/de/"))])[1].verdict == "allow"


def test_benchmark_windows_equal_plain_search(spark, odd_docs, no_docs):
    words = [f"w{k}" for k in range(40)]
    items = [(1, " ".join(words[:12])), (2, "Short, item!"), (3, None), (4, "..."), (5, " ".join(words[2:14])), (6, "ünï 日本"), (11, " ".join(words[:12]))]
    texts = [
        "intro " + ", ".join(words[:11]).upper() + " outro", " ".join(words[:9]), "a short ITEM and short item item", " ".join(words), "x" * 100,
        "ÜNÏ 日本 ünï-日本", None, "", "short item short item",
    ]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, row long")
    docs = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, spans string")

    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    found = {r.row.doc_id: r for r in decontaminate.find_benchmark_text(docs, benchmark).collect()}
    for k, text in enumerate(texts):
        have, hit, names = split(text), set(), set()
        for item, wanted in items:
            wanted = split(wanted)
            for a in range(max(1, len(wanted) - 9)) if wanted else ():
                window = wanted[a : a + 10]
                for b in range(len(have) - len(window) + 1):
                    if have[b : b + len(window)] == window:
                        hit |= set(range(b, b + len(window)))
                        names.add(str(item))
        assert (found[k].n_words, found[k].n_hit, found[k].items) == (len(have), len(hit), sorted(names)), text
        inside = [w for s in found[k].spans for w in split(text[s.start : s.end])]
        assert inside == [have[w] for w in sorted(hit)]
    assert decontaminate.find_benchmark_text(no_docs, benchmark).count() == 0
    clean = decontaminate.find_benchmark_text(odd_docs, benchmark.limit(0), keep=odd_docs.columns).collect()
    assert len(clean) == odd_docs.count() and not any(r.n_hit for r in clean)


def test_blocks_of_patterns_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k, k + 14))) for k in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(0, " ".join(f"w{j}" for j in range(60))), (1, "clean")], "doc_id long, text string")
    whole = decontaminate.find_benchmark_text(docs, items).collect()
    assert len(decontaminate.pattern_files(items, "item_id", "text", 10)) == 1
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 80)
    monkeypatch.setattr(decontaminate, "SCAN_BYTES", 80)
    assert len(decontaminate.pattern_files(items, "item_id", "text", 10)) >= 10
    assert decontaminate.find_benchmark_text(docs, items).collect() == whole


def test_every_link_of_a_page_is_an_alias(spark):
    link = '<link rel="%s" href="%s">'
    page = "http://s.net/a/b/page"
    cases = {
        "second canonical": (link % ("canonical", "http://other.net/1") + link % ("canonical", "http://b.com/de/1"), "http://b.com/de/1"),
        "second refresh": ('<meta http-equiv=refresh content="1;url=http://other.net/2"><meta http-equiv=refresh content="1;url=http://b.com/de/2">', "http://b.com/de/2"),
        "other rel tokens": (link % ("alternate canonical", "http://b.com/de/3"), "http://b.com/de/3"),
        "canonical unquoted": ("<link href=http://b.com/de/4 rel=canonical>", "http://b.com/de/4"),
        "dots": (link % ("canonical", "../.././de/./5?a=../x"), "http://s.net/de/5?a=../x"),
        "dots at the end": (link % ("canonical", ".."), "http://s.net/a/"),
        "dots above the root": (link % ("canonical", "../../../../../de/6"), "http://s.net/de/6"),
        "dots of a whole url": (link % ("canonical", "http://b.com/x/../de/7"), "http://b.com/de/7"),
        "query alone": (link % ("canonical", "?a=1"), page + "?a=1"),
        "url in a query": (link % ("canonical", "/go?to=http://b.com/de/8"), "http://s.net/go?to=http://b.com/de/8"),
    }
    for name, (html, target) in cases.items():
        pages = spark.createDataFrame([(1, page, html)], "page_id long, url string, html string")
        assert target in {r.b for r in urlrules.page_links(pages).collect()}, name
    nothing = [link % ("not-canonical", "http://b.com/de/9"), link % ("canonicals", "http://b.com/de/9"), link % ("canonical", "mailto:a@b?c=http://b.com/de/"), None]
    pages = spark.createDataFrame([(k, page, html) for k, html in enumerate(nothing)], "page_id long, url string, html string")
    assert {r.b for r in urlrules.page_links(pages).collect()} <= {None}
    found = judged(spark, [(1, page, cases["second canonical"][0]), (2, "http://b.com/x/../de/1", None), (3, "http://s.net/q", link % ("canonical", "#top"))])
    assert found[1].verdict == "block" and found[1].component == found[2].component and found[3].component is None
