"""Token files, packing, page text, archives and the pipeline: round trips and plain versions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortrates.llm import decontaminate, html_extract, line_dedup, packing, quality_classifier, simhash, token_files, warc
from cohortrates.llm.common import settled, shared_folder
from cohortrates.llm.files import open_random
from cohortrates.llm.html_labels import LABELLED
from cohortrates.llm.tokens import BYTES, WORDS, Encoder, encoder, vocabulary

from .conftest import prose
from .test_copies import plain_alignment, plain_classes, plain_fingerprint
from .test_filters import plain_dedup

VOCABULARIES = [("byte_bpe_50k.json", BYTES), ("word_bpe_49k.json", WORDS)]


@pytest.fixture(scope="module")
def encoders():
    return {name: Encoder(vocabulary(name), scheme, remembered=500) for name, scheme in VOCABULARIES}


@pytest.mark.parametrize("name", [n for n, _ in VOCABULARIES])
def test_ids_equal_the_library_s(name, encoders, rows):
    encode = encoders[name]
    rng = random.Random(4)
    letters = "ab cD  \n\t'sE,.!1 2é́ßİΣ中ª²\x1c\xa0\r\x0b\x85<|endoftext|>don't  "
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(5000)]
    for text in [t or "" for _, t in rows] + made:
        assert encode(text) == encode.whole(text), text


@pytest.mark.parametrize("name", [n for n, _ in VOCABULARIES])
def test_ids_equal_those_of_a_library_loaded_afresh(name, encoders):
    plain = Tokenizer.from_file(vocabulary(name))
    added = [token.content for token in plain.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    for token in [*added, *[a.upper() for a in added], "<|", "<|endoftext", "<| endoftext |>"]:
        for text in (token, f"one {token} two", f"one{token}{token}\n two", f"é\xa0{token} x", f"a  {token}  b " * 3):
            want = np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            assert encoders[name](text) == want, text


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library_s_for_any_text(text):
    for name, scheme in VOCABULARIES:
        encode = encoder(vocabulary(name), scheme)
        assert encode(text) == encode.whole(text)


@pytest.mark.parametrize("frame", [256, 1 << 18])
def test_token_files_round_trip(docs, rows, encoders, frame):
    encode = encoders["byte_bpe_50k.json"].whole
    got = token_files.round_trip(docs, frame=frame).collect()
    ids = [(i, encode(t or "") + struct.pack("<I", 2)) for i, t in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(b) // 4, zlib.crc32(b)) for i, b in ids)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [r.doc_id is None for r in ordered] == sorted([r.doc_id is None for r in ordered], reverse=True)
    named = [r.doc_id for r in ordered if r.doc_id is not None]
    assert named == sorted(named)


def test_reader_decompresses_requested_documents_only(spark, docs, rows, encoders):
    manifest = token_files.write(docs.coalesce(1), shared_folder(spark, "test-ids"), frame=1024)
    wanted = dict(rows)[30]
    for row in manifest.collect():
        with open_random(row.path) as source:
            reader = token_files.Reader(source)
            if 30 not in reader.index["id"]:
                continue
            (found,) = reader.ids(30)
            assert found.tobytes() == encoders["byte_bpe_50k.json"].whole(wanted) + struct.pack("<I", 2)
            assert reader.plain <= len(found) * 4 + 2 * 1024
            assert reader.ids(-5) == []
            data = open_random(row.path).readall()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.startswith(b"") and len(plain) % 4 == 0
    spoiled = bytearray(data)
    spoiled[40] ^= 255
    reader = token_files.Reader(_File(bytes(spoiled)))
    with pytest.raises((token_files.Damaged, zstandard.ZstdError)):
        for i in range(len(reader.index)):
            list(reader.parts(i))


class _File(io.BytesIO):
    def size(self) -> int:
        return len(self.getvalue())


def test_token_files_take_no_rows(no_docs):
    assert token_files.round_trip(no_docs).count() == 0


def check_packed(pieces: list, ids: list[tuple], window: int) -> None:
    """``pieces`` as pack returns them; ``ids`` the id bytes of each document."""
    left = Counter((p.doc_id, p.doc_tokens, p.start, p.length, p.ids_crc32) for p in pieces)
    for i, b in ids:  # each document's ids lie in a chain of pieces, which no other document uses
        at, n = 0, len(b) // 4
        while at < n:
            ends = [k for k in left if k[:3] == (i, n, at) and left[k] and k[4] == zlib.crc32(b[4 * at : 4 * (at + k[3])])]
            assert ends, (i, at)
            left[ends[0]] -= 1
            at += ends[0][3]
    assert not +left
    assert sum(p.length for p in pieces) == sum(len(b) // 4 for _, b in ids)
    by_window: dict[int, list] = {}
    for p in pieces:
        by_window.setdefault(p.sequence_id, []).append(p)
    for inside in by_window.values():
        place = 0
        for p in sorted(inside, key=lambda p: p.offset):
            assert p.offset == place and p.length > 0
            place += p.length
        assert place == window or (place < window and place & (place - 1) == 0)


def test_packing_of_documents(docs, rows, encoders):
    encode = encoders["word_bpe_49k.json"].whole
    ids = [(i, encode(t or "") + struct.pack("<I", 1)) for i, t in rows]
    for block in (500, packing.BLOCK):
        got = packing.pack(docs, block=block).collect()
        check_packed(got, ids, packing.WINDOW)
        for doc_id in {i for i, _ in ids}:
            texts = [b for i, b in ids if i == doc_id]
            own = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in got if p.doc_id == doc_id)
            if len(texts) == 1:
                spans = sorted(own)
                assert [s for s, *_ in spans] == [0, *np.cumsum([n for _, n, *_ in spans])[:-1].tolist()]
                assert all(c == zlib.crc32(texts[0][4 * s : 4 * (s + n)]) and w == len(texts[0]) // 4 for s, n, c, w in spans)
            else:
                assert sum(n * k for (_, n, *_), k in own.items()) == sum(len(b) // 4 for b in texts)


@given(st.lists(st.integers(1, 90), max_size=60), st.integers(8, 64))
@settings(max_examples=200, deadline=None)
def test_every_token_lies_in_one_piece(lengths, window):
    windows, left = packing.pack_lengths(list(enumerate(lengths)), window, last=True)
    assert not left
    spans = sorted(p for w in windows for p in w)
    for doc, n in enumerate(lengths):
        place = 0
        for _, at, size in (p for p in spans if p[0] == doc):
            assert at == place
            place += size
        assert place == n
    sizes = [sum(n for *_, n in w) for w in windows]
    assert all(s == window or (s < window and s & (s - 1) == 0) for s in sizes)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(1, 60))
@settings(max_examples=300, deadline=None)
def test_fill_comes_closest(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    taken = packing.best_fill(counts, room)
    assert all(n <= counts[k] for k, n in taken.items()) and sum(k * n for k, n in taken.items()) == max(sums)


def test_packing_takes_no_rows(no_docs):
    assert packing.pack(no_docs).count() == 0


PAGES = [
    ("<html><body><nav><a href='/'>Home</a></nav><article><h1>Hello &amp; bye</h1><p>One  two\n three four five.<p>Sh.</p></article>"
     "<div class='comments'><p>I think this is a fine page, thank you very much for it</p></div></body></html>", "Hello & bye\n\nOne two three four five.\n\nSh."),
    ("<main><p>First &lt;b&gt; &#233;&nbsp;x</p><script>if (a < b) document.write('<p>no</p>')</script><!-- <p>no</p> --><p>Last one here", "First <b> é x\n\nLast one here"),
    ("", ""),
    (None, ""),
    ("<div class=\"ad\">Buy this now, it is cheap and good</div><footer>&copy; me</footer>", ""),
    ("no markup at all, but quite some words that make up a text of its own", "no markup at all, but quite some words that make up a text of its own"),
    ("<p", ""),
    ("<article><p>" + "word " * 30_000 + "</p></article>", ("word " * 30_000).strip()),
]


def test_page_text(spark):
    data = [(i, f"http://a/{i}", h, 1) for i, (h, _) in enumerate(PAGES)] + [(0, None, PAGES[0][0], 2), (None, None, PAGES[1][0], 3)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, n_chars int").withColumnRenamed("n_chars", "text")
    got = Counter(map(tuple, html_extract.extract(pages).collect()))
    want = [(i, f"http://a/{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)]
    want += [(0, None, PAGES[0][1], len(PAGES[0][1])), (None, None, PAGES[1][1], len(PAGES[1][1]))]
    assert got == Counter(want)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_tree_on_pages_it_has_not_seen():
    """Each tenth of the labelled pages in turn is left out of training."""
    right = total = 0
    for i in range(10):
        tree = html_extract.trained([p for k, p in enumerate(LABELLED) if k % 10 != i])
        for markup, marks in LABELLED[i::10]:
            got = tree.predict(html_extract.block_features(html_extract.blocks(markup)))
            right += sum(a == (m == "+") for a, m in zip(got, marks, strict=True))
            total += len(marks)
    assert right / total > 0.95


@given(st.text(alphabet="<>/ap\"'=!- &;xscript\n", max_size=200))
@settings(max_examples=300, deadline=None)
def test_any_markup_is_parsed(markup):
    html_extract.blocks(markup)


def pages_for_archives() -> list[tuple]:
    same = "<p>Same page for all</p>"
    data = [(i, f"http://h/{i}", f"<p>page {i} é {prose(i, 50)}</p>") for i in range(20)]
    data += [(100 - i, "http://h/x y\r\nInjected: 1", same) for i in range(10)] + [(50, None, None), (51, "http://h/e", ""), (91, "http://h/9", same)]
    data += [(None, "http://h/n", same), (None, "http://h/n", "alone"), (300, "http://h/l", "long " * 5000), (301, "http://h/l", "long " * 5000)]
    return data


@pytest.mark.parametrize(("chunk", "least"), [(warc.CHUNK, 0), (64, 0), (1000, 1)])
def test_archives_round_trip(spark, chunk, least):
    data = pages_for_archives()
    pages = spark.createDataFrame([(i, u, h, 0) for i, u, h in data], "page_id long, url string, html string, size int")
    got = warc.round_trip(pages, least, chunk).collect()
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len((h or "").encode()), sha(h)) for i, _, h in data)
    groups: dict[str, list] = {}
    for r in got:
        groups.setdefault(r.payload_digest, []).append(r)
    for group in groups.values():
        first = min((r.page_id for r in group if r.page_id is not None), default=None)
        if group[0].payload_bytes < least:
            assert all((r.record_type, r.refers_to) == ("response", None) for r in group)
            continue
        (response,) = [r for r in group if r.record_type == "response"]
        assert response.page_id == first and response.refers_to is None
        assert all(r.refers_to == first for r in group if r.record_type == "revisit")


def test_archives_are_plain_warc(spark):
    pages = spark.createDataFrame(pages_for_archives(), "page_id long, url string, html string")
    chunks = settled(warc.chunk_table(pages, 100), "test-chunks")
    assert chunks.where("octet_length(data) > 100").count() == 0
    manifest = warc.write(chunks, warc.revisits(chunks, 0, 100), shared_folder(spark, "test-archives")).collect()
    assert sum(r.records for r in manifest) == len(pages_for_archives())
    payloads = Counter()
    for row in manifest:
        data = gzip.decompress(open_random(row.path).readall())
        for record in data.split(b"WARC/1.1\r\n")[1:]:
            head, http, rest = record.split(b"\r\n\r\n", 2)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n"))
            assert "Injected" not in fields and fields["WARC-Record-ID"].startswith("<urn:page:")
            body = rest[: int(fields["Content-Length"]) - len(http) - 4]
            assert rest == body + b"\r\n\r\n"
            payloads[fields["WARC-Type"], body] += 1
    assert payloads["revisit", b""] == 13
    assert {b for t, b in payloads if t == "response"} == {(h or "").encode() for _, _, h in pages_for_archives()}
    whole = b"".join(gzip.decompress(open_random(r.path).readall()) for r in manifest)
    assert len(list(warc.records(io.BytesIO(whole)))) == len(pages_for_archives())
    for broken in (whole.replace(b"<p>page 3 ", b"<p>page 4 "), whole[:-40], whole.replace(b"\r\n\r\nWARC", b"\r\n\r\n\r\nWARC", 1)):
        with pytest.raises(warc.Damaged):
            list(warc.records(io.BytesIO(broken)))


def test_chunks_of_a_record_meet_whatever_splits_hold_them(spark):
    """Records lie across row groups and read splits, and the side with the digests is small enough to broadcast."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", prose(i, 6000)) for i in range(12)], "page_id long, url string, html string")
    folder = shared_folder(spark, "test-split-chunks")
    warc.chunk_table(pages.coalesce(1), 500).write.option("parquet.block.size", 1 << 14).option("compression", "none").parquet(folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 15))
    try:
        chunks = spark.read.parquet(folder)
        lying = chunks.select("record", F.spark_partition_id().alias("split")).distinct().groupBy("record").count()
        assert lying.where("count > 1").count() > 6
        manifest = warc.write(chunks, warc.revisits(chunks, 0, 500), shared_folder(spark, "test-archives"))
        got = warc.read(manifest).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(str(r.page_id), len(r.html.encode()), base64.b32encode(hashlib.sha1(r.html.encode()).digest()).decode(), "response") for r in pages.collect()]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type) for r in got) == sorted(want)
    with pytest.raises(Exception, match="comes where chunk"):
        warc.write(chunks.where("chunk_no <> 3"), warc.revisits(chunks, 0, 500), shared_folder(spark, "test-archives"))


def test_archives_take_no_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_stages(spark, docs, rows, tmp_path):
    """Each stage against a plain version on the rows that the stage before it kept; planted copies go, clean texts stay."""
    folder = str(tmp_path / "tables")
    labels = [(i, int(i < 200), 0) for i in range(230)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, prose(500 + 4, 30)), (2, prose(1, 40)), (3, " ".join("odd" if k % 5 == 4 else w for k, w in enumerate(prose(20, 40).split())))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    kept = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(settled(stage(spark, kept[-1], folder), name))
    assert all(k.schema.names == docs.schema.names for k in kept[:-1])
    pairs = [[(r.doc_id, r.text) for r in k.select("doc_id", "text").collect()] for k in kept[:-1]]
    good = quality_classifier.score_documents(kept[0], spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1")
    assert Counter(i for i, _ in pairs[1]) == Counter(r.doc_id for r in good.collect())
    assert {*range(40), *range(100, 112), *range(120, 126)} <= {i for i, _ in pairs[1]}
    assert Counter(pairs[2]) == Counter((i, t) for i, _, _, t in plain_dedup(pairs[1], line_dedup.MIN_DOCUMENTS))
    prints = {plain_fingerprint(t) for _, t in pairs[2]}
    label = plain_classes(sorted(prints), 2)
    classes = Counter(label[plain_fingerprint(t)] for _, t in pairs[2])
    assert Counter(label[plain_fingerprint(t)] for _, t in pairs[3]) == Counter(classes.keys()) and max(classes.values()) >= 12
    assert sum(100 <= (i or 0) < 112 for i, _ in pairs[3]) == 1 and Counter(pairs[3]) <= Counter(pairs[2])
    words = {j: [decontaminate.word_hash(w) for w in decontaminate.words_of(t)] for j, t in items}
    copies = {i for i, t in pairs[3] if any(plain_alignment([decontaminate.word_hash(w) for w in decontaminate.words_of(t[:2000])], own) >= len(own) for own in words.values())}
    assert {1, 4, 20} <= copies and {i for i, _ in pairs[3]} - copies >= {2, 3, 5, 6, 7}
    assert Counter(pairs[4]) == Counter(p for p in pairs[3] if p[0] not in copies)
    assert {r.doc_id for r in kept[5].collect()} == {r.doc_id for r in kept[4].collect()}
    whole = corpus_pipeline.run(spark, folder)
    assert whole.select("doc_id", "ids_crc32", "start", "length").count() == kept[5].count()
    assert corpus_pipeline.run(spark, folder).agg({"length": "sum"}).first() == kept[5].agg({"length": "sum"}).first()
