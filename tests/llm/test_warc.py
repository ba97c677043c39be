import gzip
import hashlib
import os

from llm_cases import SMALL, corpus, rows, words  # noqa: F401

from switchboard.llm import warc as W

SCHEMA = "page_id long, url string, html string, offset string, payload string, kind string"


def record(payload, uri="http://a/", kind="response", digest=None, newline=b"\r\n"):
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:page:1>", b"WARC-Target-URI: " + uri.encode(),
            b"WARC-Payload-Digest: sha1:" + (digest or hashlib.sha1(payload).hexdigest()).encode(),
            b"Content-Length: %d" % len(payload)]
    return newline.join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def read(data):
    return [(x[0], x[1], x[2], x[4] if x[0] == "record" else None) for x in W.read_archive(data)]


def covered(data):
    """Records and gaps lie side by side, up to separators without content."""
    at = 0
    for _, offset, length, _ in read(data):
        assert offset == at
        at += length
    return at == len(data)


PAYLOADS = [b"one" * 400, b"", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3, os.urandom(3000), b"last"]


def test_sound_archives_read_back():
    plain = b"".join(map(record, PAYLOADS))
    members = b"".join(gzip.compress(record(p)) for p in PAYLOADS)
    whole = gzip.compress(plain)
    for data in (plain, members, whole):
        assert [x[3] for x in read(data)] == PAYLOADS
    assert covered(plain) and covered(members)


def test_damage_costs_only_the_damaged_record():
    for make in (record, lambda p: gzip.compress(record(p))):
        parts = [make(p) for p in PAYLOADS]
        for hit in range(len(parts)):
            damaged = list(parts)
            broken = bytearray(damaged[hit])
            # inside the headers or the stream, so the record cannot pass its checks
            place = 30 if make is not record else broken.index(b"sha1:") + 7
            broken[place] ^= 0xFF
            damaged[hit] = bytes(broken)
            data = b"".join(damaged)
            found = read(data)
            want = [p for k, p in enumerate(PAYLOADS) if k != hit]
            got = [x[3] for x in found if x[0] == "record" and x[3] in PAYLOADS]
            # the payload that looks like records inside may yield its inner records when its own record is broken
            assert [p for p in got if p] == [p for p in want if p]
            assert any(x[0] == "gap" for x in found)
            if make is not record:
                gap = next(x for x in found if x[0] == "gap")
                assert gap[1] == sum(map(len, parts[:hit])) and gap[2] == len(parts[hit])
            assert covered(data)


def test_cut_missing_and_foreign_bytes():
    parts = [gzip.compress(record(p)) for p in (b"a" * 50, b"b" * 50, b"c" * 50)]
    junk = os.urandom(500).replace(W.MAGIC, b"xxx")
    data = junk + parts[0] + parts[1][:-20] + parts[2] + parts[0][:30]
    found = read(data)
    assert [x[3] for x in found if x[0] == "record"] == [b"a" * 50, b"c" * 50]
    assert [(x[1], x[2]) for x in found if x[0] == "gap"] == [
        (0, 500), (500 + len(parts[0]), len(parts[1]) - 20), (len(data) - 30, 30)]
    assert covered(data)
    plain = b"xx\r\n" + record(b"a") + record(b"bb")[:-3] + record(b"c") + b"tail"
    assert [x[3] for x in read(plain) if x[0] == "record"] == [b"a", b"c"]
    assert covered(plain)


def test_plain_and_gzip_records_in_one_file():
    body = gzip.compress(os.urandom(400))
    first = record(body).replace(b"WARC/1.1", b"WARX/1.1", 1)
    data = first + record(b"a" * 40) + gzip.compress(record(b"b" * 40)) + record(b"c" * 40)
    assert [x[3] for x in read(data) if x[0] == "record"] == [b"a" * 40, b"b" * 40, b"c" * 40]
    assert [x[1:3] for x in read(data) if x[0] == "gap"] == [(0, len(first))] and covered(data)


def test_records_in_front_of_a_break_in_one_member():
    payloads = [os.urandom(30_000) for _ in range(8)]
    whole = gzip.compress(b"".join(map(record, payloads)))
    cut = read(whole[:-45_000])
    assert [x[3] for x in cut if x[0] == "record"] == payloads[:6] and cut[-1][:3] == ("gap", 0, len(whole) - 45_000)
    hit = bytearray(whole)
    hit[105_000] ^= 0xFF
    got = [x[3] for x in read(bytes(hit) + record(b"after")) if x[0] == "record"]
    assert got[:3] == payloads[:3] and payloads[3] not in got and got[-1] == b"after"


def test_failed_checks():
    good = record(b"payload")
    for bad, reason in ((record(b"payload", digest="0" * 40), "digest differs"),
                        (good.replace(b"Content-Length: 7", b"Content-Length: 9"), "block does not end where stated"),
                        (good.replace(b"Content-Length: 7", b"Content-Length: x"), "no content length"),
                        (good.replace(b"Content-Length: 7", b"Content-Length: 9999"), "block is cut off"),
                        (good.replace(b"WARC-Type: ", b"WARC-Type; "), "malformed header"), (b"", None), (b"junk", "no version line")):
        found = list(W.read_archive(bad))
        assert [x[0] for x in found] == ["gap"] * bool(bad)
        assert not bad or found[0][3] == reason
    assert read(gzip.compress(b"")) == []


def test_base32_digests_and_http_heads():
    import base64
    body = b"<html>"
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    digest = base64.b32encode(hashlib.sha1(body).digest())
    data = (b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"
            + digest + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    (found,) = list(W.read_archive(data))
    assert W._row("p", found, True)[-3:] == (hashlib.sha1(body).hexdigest(), len(body), body)


def brute(pages):
    first = {}
    for i, html in pages:
        if i is not None and len((html or "").encode()) >= 1000:
            first[html] = max(i, first.get(html, i))
    out = []
    for i, html in pages:
        data = (html or "").encode()
        to = first.get(html) if len(data) >= 1000 and first.get(html) != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def check(spark, pages):
    frame = spark.createDataFrame([(i, "http://x/\r\ny", h, "c", "c", "c") for i, h in pages], SCHEMA)
    folder = W.write_archives(frame)
    read = W.read_archives(spark, folder)
    assert rows(W.page_records(read)) == brute(pages)
    assert read.where("kind = 'gap'").count() == 0


def test_pages_with_copies_nulls_and_long_ones(corpus):
    big, other = words(300, 1), "é" * 500
    check(corpus, [(1, big), (2, big), (9, big), (9, big), (3, None), (4, ""), (None, big), (None, "x"), (5, "small"), (6, "small"),
                   (7, other), (8, other), (10, words(200_000, 2)), (-3, big), (11, "WARC/1.1\r\n\x1f\x8b\x08" * 200)])
    check(corpus, [(None, big), (None, big)])


def test_no_pages(corpus):
    frame = corpus.createDataFrame([], SCHEMA)
    assert W.page_records(W.read_archives(corpus, W.write_archives(frame))).collect() == []


def test_the_table_and_a_damaged_archive(corpus, tmp_path):
    pages = corpus.read.parquet(f"{SMALL}/pages.parquet")
    folder = W.write_archives(pages)
    local = folder.removeprefix("file://")
    (name,) = [n for n in os.listdir(local) if n.startswith("part-")]
    with open(os.path.join(local, name), "rb") as file:
        data = bytearray(file.read())
    sound = [x for x in W.read_archive(bytes(data))]
    hit = sound[10]
    data[hit[1] + hit[2] // 2] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(data)
    got = W.read_archives(corpus, str(tmp_path)).collect()
    assert sum(r.kind == "record" for r in got) == pages.count() - 1
    (gap,) = [r for r in got if r.kind == "gap"]
    assert (gap.offset, gap.length) == (hit[1], hit[2]) and gap.path.endswith("a.warc.gz") and gap.reason


def test_damage_full_of_version_lines_is_read_once():
    import time
    from switchboard.llm.warc import read_archive, read_plain
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for junk in (b"WARC/1.0\r\n", b"WARC/1.1\r\nA: b\r\n", b"WARC/1.0\r\nx: WARC/1.1\r\n"):
        took = []
        for n in (50_000, 200_000):
            data = junk * (n // len(junk)) + record
            began = time.perf_counter()
            for read in (read_plain, read_archive):
                found = list(read(data))
                assert [x[0] for x in found][-1] == "record" and found[-1][4] == b"abc"
            took.append(time.perf_counter() - began)
        assert took[1] < 8 * took[0] + 1
    assert [x[0] for x in read_plain(b"WARC/1.1\r\n" * 100_000)] == ["gap"]
