import hashlib
import io

import pytest
import zstandard

from skyflow.llm import warc
from skyflow.plans.staging import new_folder

SCHEMA = "page_id long, url string, html string, digest int, first string"


def frame(number, data):
    return number.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data


def sound(kind="response", payload=b"hello", **changes):
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": "<urn:page:1>",
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
    }
    return warc.record(list((fields | changes).items()), b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload)


def expected(pages):
    first = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        if len(payload) >= 100 and i is not None:
            first[payload] = min(i, first.get(payload, i))
    found = []
    for i, _, html in pages:
        payload = (html or "").encode()
        refers = first.get(payload) if first.get(payload) != i else None
        found.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(found, key=repr)


def test_nulls_copies_long_texts_and_clashing_names(spark, rows):
    same, null_only = "<p>gleich äöü</p>" * 20, "only without id " * 10
    pages = [(5, "u", same), (3, "u 3\r\nWARC-Type: x", same), (9, None, same), (None, "u", same), (3, "u", same)]
    pages += [(None, "u", null_only), (None, "u", null_only), (11, "u", None), (12, "u", ""), (13, "u", "x" * 99), (14, "u", "x" * 99)]
    pages += [(15, "u", "y" * 100), (16, "u", "y" * 100), (17, "u", "long " * 2_000_000), (-4, "u", "ß" * 50), (18, "u", "ß" * 50)]
    df = spark.createDataFrame([(*p, 1, "f") for p in pages], SCHEMA)
    assert rows(warc.report(df)) == expected(pages)
    assert rows(warc.report(df.limit(0))) == []


def test_hot_payload(spark, rows):
    pages = [(i, "u", "hot page " * 20 if i % 3 else f"page {i} " * 20) for i in range(3000)]
    assert rows(warc.report(spark.createDataFrame([(*p, 1, "f") for p in pages], SCHEMA).repartition(7))) == expected(pages)


def test_archives_have_a_dictionary_and_hold_the_pages(spark):
    pages = [(i, f"http://a/{i}", f"<html><body>page number {i}, {'text ' * (i % 9)}</body></html>" * 4) for i in range(6000)]
    df = spark.createDataFrame([(*p, 1, "f") for p in pages], SCHEMA).coalesce(2)
    archives = warc.write_archives(df, new_folder(spark, "warc-test"), date="2024-05-05T00:00:00Z")
    made = archives.collect()
    assert sum(a.records for a in made) == 6000 + len(made)
    for a in made:
        with open(a.path.removeprefix("file://"), "rb") as stream:
            data = stream.read()
        assert len(data) == a.bytes and int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    found = warc.read_archives(archives).filter("record_type = 'response'").collect()
    assert sorted((r.record_id, r.target_uri, r.payload.decode()) for r in found) == sorted((f"<urn:page:{i}>", u, h) for i, u, h in pages)
    assert {r.problem for r in found} == {None}
    # A left-over archive is in no list, but found by a search of the folder.
    folder = made[0].path.rsplit("/", 1)[0]
    assert warc.archives_in(spark, folder).count() == len(made)
    assert warc.read_archives(warc.archives_in(spark, folder)).count() == 6000 + len(made)


def read(data, size=warc.CHUNK):
    return list(warc.frames(io.BytesIO(data)))


def test_frames():
    samples = [b"some text %d and more of it %d" % (i, i * i) for i in range(2000)]
    trained = zstandard.train_dictionary(2048, samples)
    with_it = zstandard.ZstdCompressor(dict_data=trained, write_checksum=True)
    plain = zstandard.ZstdCompressor(write_checksum=True)
    head = frame(warc.DICTIONARY_FRAME, trained.as_bytes())
    long = b"0123456789" * 100_000 + bytes(range(256)) * 3000
    content = [b"", b"a", long, samples[7], samples[8]]
    body = b"".join(map(with_it.compress, content))
    assert [d for _, d, _ in read(head + body)] == content
    packed = frame(warc.DICTIONARY_FRAME, plain.compress(trained.as_bytes()))
    assert [d for _, d, _ in read(packed + body)] == content
    # Places are where frames begin; other skippable frames are passed over.
    found = read(plain.compress(b"x") + frame(0x184D2A50, b"note") + plain.compress(b"y"))
    assert [(d, p) for _, d, p in found] == [(b"x", None), (b"y", None)]
    assert found[1][0] == len(plain.compress(b"x")) + 12
    assert read(b"") == []
    # A wrong dictionary, a damaged frame, and files that end early.
    assert read(body)[-1][2].startswith("frame")
    assert read(frame(warc.DICTIONARY_FRAME, bytes.fromhex("37a430ec") + b"\0" * 40) + body)[-1][2] is not None
    damaged = plain.compress(b"x") + plain.compress(long)[:-9]
    assert read(damaged)[0][1] == b"x" and read(damaged)[-1][2] == "frame cut off"
    changed = bytearray(plain.compress(long))
    changed[-1] ^= 1
    assert read(bytes(changed))[-1][2].startswith("frame")
    for cut in (2, 6, 20):
        assert read(head[:cut])[-1][2] == "frame cut off"


def test_records():
    assert warc.parsed(sound())["payload"] == b"hello"
    assert warc.parsed(sound().replace(b"WARC/1.1", b"WARC/1.0"))["payload_bytes"] == 5
    folded = sound(**{"WARC-Target-URI": "http://a\r\n /b"})
    assert warc.parsed(folded)["target_uri"] == "http://a /b"
    other = warc.parsed(warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", "<a>"), ("WARC-Date", "d")], b"block"))
    assert (other["payload"], other["payload_digest"]) == (b"block", hashlib.sha256(b"block").hexdigest())


@pytest.mark.parametrize(
    "data, words",
    [
        (b"", "no record header"),
        (sound()[:-2], "content-length"),
        (sound() + b"x", "content-length"),
        (sound().replace(b"WARC/1.1", b"WARC/9.9"), "no record header"),
        (sound(**{"WARC-Date": ""}), "warc-date is missing"),
        (sound(**{"WARC-Date": "d\r\nWARC-Date: e"}), "stands twice"),
        (sound(**{"A": "b\r\nno colon here"}), "without a name"),
        (sound().replace(b"Content-Length: 5\r", b"Content-Length: 4\r"), "HTTP content-length 4"),
        (sound().replace(b"hello", b"hallo"), "differs from its digest"),
        (sound("revisit"), "refers-to"),
    ],
)
def test_faults(data, words):
    with pytest.raises(ValueError, match=words):
        warc.parsed(data)


def test_faults_are_rows_and_fail_the_query(spark, tmp_path):
    compress = zstandard.ZstdCompressor(write_checksum=True).compress
    path = tmp_path / "a.warc.zst"
    path.write_bytes(compress(sound()) + compress(sound()[:-1]) + compress(sound()))
    (tmp_path / "empty.warc.zst").write_bytes(b"")
    found = warc.read_archives(warc.archives_in(spark, str(tmp_path))).orderBy("offset").collect()
    assert [r.problem is None for r in found] == [True, False, True]
    assert found[1].record_type is None and found[1].offset == len(compress(sound()))
