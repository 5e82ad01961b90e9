"""Archives as an exact round trip, chunk by chunk, and the plan against plain grouping."""

import gzip
import hashlib
import random

import pyarrow.fs as pafs
import pytest

from anamnesis.llm import warc


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, payload string, data string")


def rows():
    rng = random.Random(3)
    big = "".join(rng.choice("abé漢\n") for _ in range(900))
    out = [(i, f"http://h/{i}", "page " + "p" * 95 + str(i % 7)) for i in range(40)]
    out += [(50, None, None), (51, "", ""), (52, "http://a b\r\nx", "short"), (53, "u", "short"), (54, "u", big), (49, "u", big), (None, "u", big),
            (60, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (None, "u", "q" * 200), (None, "u", "q" * 200), (70, "u", "z" * 99), (71, "u", "z" * 99),
            (72, "u", "é" * 50), (73, "u", "é" * 50), (80, "u", "r" * 300), (80, "u", "r" * 300), (81, "u", "r" * 300), (90, "u", "k" * 64), (91, "u", "k" * 128)]
    return out


def plain(rows):
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = least.get(h or "")
        later = len(data) >= 100 and first is not None and (i is None or i > first)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", first if later else None))
    return out


key = lambda r: tuple(map(str, r))


@pytest.mark.parametrize("chunk", [64, 1 << 18])
def test_round_trip(spark, chunk):
    pages = pages_of(spark, rows())
    chunks = warc.read(warc.archive(pages, chunk=chunk), chunk)
    assert sorted(map(tuple, warc.digests(chunks).collect()), key=key) == sorted(plain(rows()), key=key)
    texts = {(i, hashlib.sha256((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in rows()}
    joined = {}
    for r in sorted(chunks.where("record_type = 'response' and page_id is not null").collect(), key=lambda r: (r.page_id, r.chunk_no)):
        assert len(r.data) <= chunk
        joined.setdefault(r.page_id, []).append(r)
    for i, parts in joined.items():
        if i == 80:  # the same row twice
            continue
        data = b"".join(bytes(p.data) for p in parts)
        assert [p.chunk_no for p in parts] == list(range(len(parts))) and [p.is_last for p in parts][-1]
        assert data == texts[i, parts[-1].payload_digest]
        for n, p in enumerate(parts):
            part = b"".join(bytes(x.data) for x in parts[:n + 1])
            assert (p.running_digest, p.running_bytes) == (hashlib.sha256(part).hexdigest(), len(part))


def test_files_are_warc(spark):
    manifest = warc.archive(pages_of(spark, [(1, "http://x/y z", "hello"), (2, "u", "w" * 100), (3, "u", "w" * 100)]), file_bytes=1)
    paths = manifest.collect()
    assert len(paths) == 3 and sum(r.records for r in paths) == 3
    found = []
    for r in paths:
        fs, path = pafs.FileSystem.from_uri(r.path)
        found.append(gzip.decompress(fs.open_input_stream(path).read()))
    hello = next(f for f in found if f.endswith(b"\r\n\r\nhello\r\n\r\n"))
    assert hello.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\r\nWARC-Target-URI: http://x/yz\r\n" in hello
    again = next(f for f in found if b"revisit" in f)
    assert b"WARC-Refers-To: <urn:page:2>" in again and b"Content-Length: 100" in again and again.count(b"w" * 5) == 0


def names_of(manifest):
    found = []
    for r in manifest.collect():
        fs, path = pafs.FileSystem.from_uri(r.path)
        data = gzip.decompress(fs.open_input_stream(path).read())
        found += [line for line in data.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    return found


def test_no_two_records_share_a_name(spark):
    found = names_of(warc.archive(pages_of(spark, rows())))
    assert len(found) == len(rows()) == len(set(found))
    assert b"WARC-Record-ID: <urn:page:54>" in found


def test_payloads_meet_others_in_chunks_only(spark):
    """No shuffle, sort or join holds a whole payload."""
    chunks = warc.record_chunks(pages_of(spark, rows()).selectExpr("page_id", "url", "cast(html as binary) payload"), chunk=64)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if any(f"{node} " in line or f"{node}[" in line for node in ("Exchange", "Sort", "SortMergeJoin", "BroadcastHashJoin")):
            assert "payload#" not in line
    narrow = warc.marks(pages_of(spark, rows()).selectExpr("page_id", "url", "cast(html as binary) payload"))
    assert narrow.columns == ["page_id", "payload_digest", "refers_to", "repeated"]


def test_oversized_and_many_equal_payloads(spark):
    big = "é" * 8_000_000
    many = [(i, "u", big) for i in (5, 3, 9)] + [(100 + i, "u", "same " * 60) for i in range(300)] + [(7, "u", "again " * 50)] * 40
    pages = pages_of(spark, many).repartition(6)
    got = warc.round_trip(spark, pages)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(many), key=key)
    chunks = warc.read(warc.archive(pages, chunk=1 << 20), 1 << 20)
    assert max(len(r.data) for r in chunks.where("payload_bytes > 1000000").select("data").collect()) <= 1 << 20


def test_a_changed_archive_is_refused(spark):
    manifest = warc.archive(pages_of(spark, [(1, "u", "hello")]))
    fs, path = pafs.FileSystem.from_uri(manifest.first().path)
    data = gzip.decompress(fs.open_input_stream(path).read())
    with fs.open_output_stream(path) as out:
        out.write(gzip.compress(data.replace(b"hello", b"jello")))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read(manifest).collect()


def test_chunks_never_stand_in_one_array(spark):
    texts = ["", "a", "b" * 63, "c" * 64, "d" * 65, "e" * 1000, None]
    pages = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page_id long, text string").selectExpr("page_id", "cast(text as binary) payload")
    chunks = warc.chunk_rows(pages, 64)
    optimized = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in optimized and "posexplode" not in optimized
    got = {}
    for r in chunks.collect():
        got.setdefault(r.page_id, []).append((r.n_chunks, r.chunk_no, None if r.data is None else bytes(r.data)))
    for i, text in enumerate(texts):
        data = None if text is None else text.encode()
        cut = [data] if not data else [data[at:at + 64] for at in range(0, len(data), 64)]
        assert got[i] == [(len(cut), n, part) for n, part in enumerate(cut)]


def test_empty_table(spark):
    assert warc.round_trip(spark, pages_of(spark, [])).count() == 0
