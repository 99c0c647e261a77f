import gzip
import hashlib
import random

from seekframe.llm import warc


def record(body, number=1, kind="response", digest=None, extra=""):
    digest = digest or hashlib.sha1(body).hexdigest()
    head = (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{number}>\r\n{extra}"
            f"WARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def shown(data):
    """(ids of the records, gaps); all bytes must be accounted for."""
    found = list(warc.salvage(data))
    at = 0
    for f in found:
        if f.size:
            assert f.start in (at, at - 0) or f.start + f.size == at
            at = max(at, f.start + f.size)
    assert at == len(data)
    return ([f.header["warc-record-id"][10:-1] for f in found if not f.reason],
            [(f.start, f.size, f.reason) for f in found if f.reason])


def test_plain_damage():
    parts = [record(b"body %d" % i * 30, i) for i in range(5)]
    starts = [sum(map(len, parts[:i])) for i in range(6)]
    whole = b"".join(parts)
    assert shown(whole) == (list("01234"), [])
    flipped = bytearray(whole)
    flipped[starts[2] - 20] ^= 1  # in the payload of record 1
    assert shown(bytes(flipped)) == (list("0234"), [(starts[1], len(parts[1]), "digest does not fit")])
    flipped = bytearray(whole)
    flipped[starts[3]] ^= 1  # in a version line
    assert shown(bytes(flipped)) == (list("0124"), [(starts[3], len(parts[3]), "no version line")])
    cut = whole[:starts[1] + 3] + whole[starts[2] + 15:]
    ids, gaps = shown(cut)
    assert ids == list("034") and [g[:2] for g in gaps] == [(starts[1], len(cut) - len(parts[3]) - len(parts[4]) - starts[1])]
    assert shown(whole[:-9]) == (list("0123"), [(starts[4], len(parts[4]) - 9, "truncated")])
    assert shown(b"junk" * 50 + whole)[0] == list("01234")
    assert shown(b"") == ([], [])
    assert shown(b"no archive") == ([], [(0, 10, "no version line")])


def test_wrong_lengths_and_headers():
    good = record(b"x" * 40, 7)
    for bad, reason in ((record(b"y" * 40, 1).replace(b"Length: 40", b"Length: 41"), "length does not fit"),
                        (record(b"y", 1).replace(b"Length: 1", b"Length: one"), "no content length"),
                        (record(b"y", 1).replace(b"WARC-Type:", b"WARC-Type"), "broken header line")):
        ids, gaps = shown(bad + good)
        assert ids == ["7"] and gaps == [(0, len(bad), reason)]


def test_records_inside_a_payload_are_not_recovered_twice():
    inner = record(b"inner", 99)
    outer = bytearray(record(b"a" + inner + b"b", 1) + record(b"after", 2))
    assert shown(bytes(outer))[0] == ["1", "2"]
    outer[outer.index(b"inner") - len(inner) + 60] ^= 0
    damaged = bytes(outer).replace(b"\r\n\r\na" + inner[:4], b"\r\n\r\nz" + inner[:4])
    ids, gaps = shown(damaged)
    assert ids == ["2"] and len(gaps) == 1


def test_gzip_members():
    parts = [gzip.compress(record(b"body %d" % i * 30, i)) for i in range(5)]
    starts = [sum(map(len, parts[:i])) for i in range(6)]
    whole = b"".join(parts)
    assert shown(whole) == (list("01234"), [])
    flipped = bytearray(whole)
    flipped[starts[2] + 30] ^= 255
    ids, gaps = shown(bytes(flipped))
    assert ids == list("0134") and [g[0] for g in gaps] == [starts[2]]
    ids, gaps = shown(whole[:starts[3] + 25] + whole[starts[4]:])
    assert ids == list("0124") and gaps[0][0] == starts[3]
    ids, gaps = shown(whole[:-5])  # the content is whole, the member's end is not
    assert ids == list("01234") and gaps[0][0] == starts[4]
    one = gzip.compress(b"".join(record(bytes(random.Random(i).randbytes(3000)), i) for i in range(5)))
    assert shown(one)[0] == list("01234")
    ids, gaps = shown(one[:len(one) // 2])
    assert ids == list("01") and len(gaps) == 1


def test_plain_and_gzip_bytes_in_one_file():
    """First bytes of gzip in a payload, and members between plain records, cost nothing."""
    parts = [record(b"\x1f\x8b\x08" * 9 + b"%d" % i, i) for i in range(3)]
    whole = b"".join(parts)
    ids, gaps = shown(b"X" + whole[1:])
    assert ids == ["1", "2"] and gaps == [(0, len(parts[0]), "no version line")]
    packed = record(gzip.compress(b"packed page" * 50), 3)
    member = gzip.compress(record(b"member", 4))
    mixed = [parts[0], packed, member, parts[1], member, parts[2]]
    starts = [sum(map(len, mixed[:i])) for i in range(7)]
    assert shown(b"".join(mixed)) == (list("034142"), [])
    draw = random.Random(5)
    for n in range(120):
        hit = n % 6
        inside = draw.randrange(len(mixed[hit]))
        if mixed[hit].startswith(b"WARC") and 10 <= inside < mixed[hit].index(b"\r\n\r\n") + 4:
            continue  # header lines have no check of their own
        at = starts[hit] + inside
        data = bytearray(b"".join(mixed))
        data[at] ^= 1 << draw.randrange(8)
        ids, gaps = shown(bytes(data))
        rest = [n for i, n in enumerate("034142") if i != hit]
        # The time in a member's header has no check either.
        assert (ids == rest and [g[:2] for g in gaps] == [(starts[hit], len(mixed[hit]))]) \
            or (not gaps and len(ids) == 6), (at, hit, ids, gaps)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip(spark, tmp_path):
    long = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60_000
    same = "s" * 1000
    rows = [(1, "http://a/ b\r\nX: y", same), (2, None, same), (9, "", same), (9, "", same), (3, "u", "s" * 999),
            (4, "u", "s" * 999), (5, "u", None), (6, "u", ""), (None, "u", same), (7, "u", long), (8, "u", long)]
    df = pages(spark, rows).selectExpr("*", "1 AS id", "2 AS body", "3 AS digest", "4 AS owner")
    for name, options in (("plain", {}), ("small", {"file_records": 2}), ("gz", {"compression": "gzip"})):
        path = str(tmp_path / name)
        warc.write_archive(df, path, **options)
        archive = warc.read_archive(spark, path)
        assert warc.gaps(archive).collect() == []
        got = warc.records(archive).withColumns({"page": warc.page_of("record_id"),
                                                 "other": warc.page_of("refers_to")}).collect()
        assert len(got) == len(rows)
        texts = {i: h for i, _, h in rows}
        largest = {same: 9, long: 8}
        for r in got:
            body = (texts[r.page] or "").encode()
            again = texts[r.page] in largest and r.page != largest[texts[r.page]]
            assert (r.record_type, r.other) == (("revisit", largest[texts[r.page]]) if again else ("response", None))
            assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha1(body).hexdigest()
            assert bytes(r.payload) == (b"" if again else body)
            assert r.uri is None or "\n" not in r.uri
    path = str(tmp_path / "empty")
    warc.write_archive(df.limit(0), path)
    assert warc.read_archive(spark, path).collect() == []


def test_damaged_files_lose_only_what_was_hit(spark, tmp_path):
    path = tmp_path / "archive"
    warc.write_archive(pages(spark, [(i, "u", f"text {i} " * 40) for i in range(50)]).coalesce(1), str(path))
    (file,) = path.glob("part-*")
    data = bytearray(file.read_bytes())
    at = data.index(b"text 20 ")
    data[at] ^= 1
    file.write_bytes(data)
    for crc in path.glob(".part-*"):
        crc.unlink()
    archive = warc.read_archive(spark, str(path))
    assert {r.record_id for r in warc.records(archive).collect()} == {
        f"<urn:page:{i}>" for i in range(50) if i != 20}
    (gap,) = warc.gaps(archive).collect()
    assert gap.start < at < gap.start + gap.size and gap.reason == "digest does not fit"


def test_a_header_of_any_length_is_read_and_gaps_fail(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.b/" + "x" * (2 << 20), "one"), (2, "http://a.b/c", "two")],
                                  "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages.coalesce(1), path)
    found = warc.whole_records(warc.read_archive(spark, path)).collect()
    assert sorted((len(r.uri), bytes(r.payload)) for r in found) == [(12, b"two"), (11 + (2 << 20), b"one")]
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "part").write_bytes(record(b"body") + b"junk")
    damaged = warc.read_archive(spark, str(tmp_path / "damaged"))
    assert warc.gaps(damaged).count() == 1
    try:
        warc.whole_records(damaged).collect()
    except Exception as error:
        assert "gap in" in str(error)
    else:
        raise AssertionError("a gap was passed over")
