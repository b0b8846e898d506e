"""Pieces, packing, archives, extraction, and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import deque

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs

from stormspan.llm import archives, extraction, packing, pieces, queries, shared

ODD = [
    None, "", " ", "  a  b ", "a\nb\n\nc", "\t x \r\n", "日本語テキスト", "🙂🙂 é ﬁ ǅ ß", "▁mark", "it's I'LL don't", "İ ŉ ΑΣ Σ",
    "x\x1cy \x1d z\x85w\xa0v", "12ab3 <|endoftext|>x <|start", "...!?'s 'S", "w" * 500, "the the  the",
]


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def plain_best(model, scores, text):
    """Best score over all segmentations, trying every piece at every place."""
    marked = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + model.penalty
        for start in range(max(0, end - 20), end):
            worth = scores.get(marked[start:end])
            if worth is not None:
                best[end] = max(best[end], best[start] + worth)
    return best[-1]


def test_pieces_are_best_and_round_trip(spark, folder):
    import sentencepiece

    path = public_tokenizers.path(pieces.VOCABULARY)
    model, raw = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {raw.id_to_piece(k): raw.get_score(k) for k in range(3, raw.get_piece_size()) if not raw.is_byte(k)}
    texts = ODD + [r["text"][:300] for r in documents(spark, folder).limit(60).collect()]
    for text in texts:
        ids, score = model.encode(text or "")
        listed = np.frombuffer(ids, "<i4").tolist()
        if text:
            assert score == pytest.approx(plain_best(model, scores, text), rel=1e-12)
            assert model.decode(listed) == text.replace("▁", " ")
            assert raw.decode(listed) == text.replace("▁", " ")
        else:
            assert listed == [] and score == 0


def test_piece_frames(spark, folder):
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(ODD)], "doc_id int, text string, ids int")
    back = pieces.decode(pieces.encode(frame.drop("ids"))).collect()
    assert [r["text"] for r in back] == [(t or "").replace("▁", " ") for t in ODD]
    rows = pieces.round_trip(documents(spark, folder)).collect()
    assert len(rows) == documents(spark, folder).count()
    assert all(r["text_sha256"] == r["decoded_sha256"] for r in rows)
    assert pieces.round_trip(frame.limit(0)).count() == 0


def test_packing_is_exact(spark, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    docs = documents(spark, folder).select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string"))
    rows = packing.pack(docs).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc in docs.collect():
        ids = tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc.pop(doc["doc_id"]), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) * 2048 - total <= 2048 * docs.rdd.getNumPartitions()
    assert packing.pack(docs.limit(0)).count() == 0


def test_sum_of_squares_choice():
    """Every placement against the plain sum over all levels."""
    rng, closed = random.Random(1), []
    windows = packing.Windows(16, closed.append)
    for k in range(400):
        size = rng.randrange(1, 16)
        counts = windows.counts.copy()

        def after(level):
            new = counts.copy()
            if level:
                new[level] -= 1
            if level + size < 16:
                new[level + size] += 1
            return int((new[1:16] ** 2).sum())

        least = min(after(h) for h in range(17 - size) if h == 0 or counts[h])
        windows.add(k, b"\1\0\0\0" * size)
        assert int((windows.counts[1:16] ** 2).sum()) == least
    windows.finish()
    assert sum(len(p[2]) // 4 for w in closed[:-1] for p in w) == 16 * (len(closed) - 1)


def pages_of(spark):
    big, other = "<p>" + "x" * 200 + "é</p>", "y" * 100
    rows = [(5, "u5", big), (3, "u3", big), (9, None, big), (7, "u\n7", "small"), (8, "u8", "small"), (1, "u1", None), (2, "u2", ""), (4, "u4", other), (4, "u4", other), (6, "u6", other), (None, "n", other)]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, kind string")


def test_archive_round_trip(spark):
    rows, frame = pages_of(spark)
    folder = shared.scratch(spark)
    index = archives.write(frame, folder).cache()
    back = archives.read(index, folder).collect()
    assert len(back) == len(rows) == index.count()
    html = {}
    for page, _, text in rows:
        html[page] = (text or "").encode()
    for r in back:
        body = html[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        first = {5: 3, 9: 3, 6: 4, None: 4}.get(r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if first else ("response", None))
        assert bytes(r["payload"]) == (b"" if first else body)
    for place in index.collect():
        head, _ = archives.read_record(folder, place["bundle"], place["frame"], place["at"], place["bytes"])
        assert head["WARC-Record-ID"] == f"<urn:page:{'' if place['record'] is None else place['record']}>"
    assert archives.archive(frame.limit(0)).count() == 0


def test_bundles_are_plain_zstandard(spark):
    import zstandard

    _, frame = pages_of(spark)
    folder = shared.scratch(spark)
    names = {r["bundle"] for r in archives.write(frame, folder).collect()}
    store, root = fs.FileSystem.from_uri(folder)
    text = b""
    for name in names:
        with store.open_input_file(f"{root}/{name}") as file:
            data = file.read()
        text += zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data)
    assert text.count(b"WARC/1.1\r\n") == frame.count()


def plain_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("table", [2, 1000])
def test_longest_common_subsequence(rng, monkeypatch, table):
    monkeypatch.setattr(extraction, "TABLE", table)
    for _ in range(150):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        p, q = extraction.shared(a, b)
        assert [a[k] for k in p] == [b[k] for k in q]
        assert p == sorted(set(p)) and q == sorted(set(q)) and len(p) == plain_length(a, b)


def test_lines():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><!-- c --><nav><a>Menu</a></nav><div class='ad'>buy</div>"
        "<article><header><h1>A &amp; B</h1></header><p>one\n two<br>three<p>four <b>f</b>ive<script>x='</p>'</script></p>"
        "<div class=\"comments\"><p>reader</p></div><form><p>mail</p></form></article><aside>side</aside>plain<footer>&copy;</footer>"
    )
    assert extraction.lines(page) == [("A & B", True), ("one two three", True), ("four five", True), ("plain", False)]
    assert extraction.lines("") == [] and extraction.lines("a < b") == [("a < b", False)]
    assert extraction.lines("<p>" * 5000 + "x")[-1] == ("x", False)


def site(k, own):
    return f"<div><p>Home and news</p></div><p>{own}</p><p>line {k}</p><div><p>All rights reserved</p></div>"


def test_shared_lines_go(spark):
    rows = [(k, f"http://www.site.org/a/{k:03d}", site(k, f"own text {k}")) for k in range(60)]
    rows += [(100, "http://lone.org/x", site(7, "stay")), (101, None, site(8, "null url")), (102, "http://[bad", "bad"), (103, "http://site.org/a/500", None)]
    rows += [(104, f"http://site.org/m/{k}", f"<article><p>mirror</p></article><p>Home {k % 1}</p>") for k in range(2)]
    rows += [rows[3]] * 2
    frame = spark.createDataFrame([(*r, [1]) for r in rows], "page_id long, url string, html string, cut array<int>").repartition(3)
    got = {(r["page_id"], r["url"]): r["text"] for r in extraction.extract(frame).collect()}
    assert extraction.extract(frame).count() == len(rows)
    assert got[5, rows[5][1]] == "own text 5\n\nline 5"
    assert got[100, "http://lone.org/x"].startswith("Home and news") and got[101, None].endswith("All rights reserved")
    assert got[103, "http://site.org/a/500"] == "" and got[104, "http://site.org/m/1"] == "mirror"
    assert extraction.extract(frame.limit(0)).count() == 0


def test_mirrored_pages_keep_their_text_and_lose_the_template(spark):
    """Runs of equal and of nearly equal pages without an article element."""
    bar = "".join(f"<div>Section {k}</div>" for k in range(6))

    def page(story, date):
        return f"<body>{bar}<div>{date}</div><p>{story * 20}</p><div>Imprint</div></body>"

    rows = [(k, f"http://a.org/a{k:03}", page("First story. ", "Monday")) for k in range(40)]
    rows += [(100 + k, f"http://a.org/b{k:03}", page("Second story. ", f"Day {k}")) for k in range(5)]
    rows += [(200, "http://a.org/c", page("Third story. ", "Friday"))]
    rows += [(300 + k, f"http://b.org/{k}", page("Mirrored. ", "Sunday")) for k in range(2)]
    got = {r["page_id"]: r["text"] for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert all(got[k] == "Monday\n\n" + ("First story. " * 20).strip() for k in range(40))
    assert all(got[100 + k] == f"Day {k}\n\n" + ("Second story. " * 20).strip() for k in range(5))
    assert got[200] == "Friday\n\n" + ("Third story. " * 20).strip()
    assert all("Mirrored." in got[300 + k] and "Section 1" in got[300 + k] for k in range(2))


def test_pairs_equal_a_plain_search(rng):
    """Every page's deletions against a search over all different neighbours, nearest first."""
    for _ in range(200):
        kinds = [([rng.randrange(6) for _ in range(rng.randrange(1, 9))]) for _ in range(4)]
        pages = [rng.choice(kinds) for _ in range(rng.randrange(1, 12))]
        sizes = [[(7 * h) % 5 + 1 for h in hashes] for hashes in pages]
        near, got = deque(maxlen=100), [set() for _ in pages]
        for k, (hashes, size) in enumerate(zip(pages, sizes)):
            for key, cut in extraction.met(near, k, hashes, size):
                got[key] |= set(cut)
        order = [k for k, p in enumerate(pages) if p not in pages[:k]]
        want = {}
        for at, k in enumerate(order):
            cut = set()
            for side in (order[:at][::-1], order[at + 1 :]):
                for other in side:
                    a, b = sorted((k, other))
                    found = extraction.template_of((pages[a], sizes[a]), (pages[b], sizes[b]))
                    if found is not None:
                        cut |= set(found[k == b])
                        break
            want[tuple(pages[k])] = cut
        assert got == [want[tuple(p)] for p in pages]


def test_names_do_not_cut_inside_articles():
    page = (
        '<article><div class="article-header related"><h1>Title</h1></div><section id="search">Body</section>'
        '<div class="comments">No</div><div class="ad">No</div><form>No</form></article><div class="related">No</div>'
    )
    assert [t for t, _ in extraction.lines(page)] == ["Title", "Body"]


def test_edges_of_ranges_count(spark):
    """The pairing does not depend on how the pages are dealt out."""
    frame = spark.createDataFrame([(k, f"http://s.org/{k:03d}", site(k, f"t{k}")) for k in range(50)], "page_id long, url string, html string")
    out = []
    for parts in ("1", "7", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(sorted(map(tuple, extraction.extract(frame).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1] == out[2]


def test_pages_keep_their_articles(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extraction.extract(pages).collect():
        own = re.search(r"<article>(.*?)(?:</article>|$)", html[r["page_id"]], re.S)[1]
        blocks = [re.sub(r"\s+", " ", re.sub("<[^>]*>", "", b.replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h1)>", own)]
        import html as entities

        assert r["text"] == "\n\n".join(entities.unescape(b) for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, folder, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    theirs = connection.sql(queries.ORACLES[name]).to_arrow_table().to_pylist()
    mine = queries.QUERIES[name](spark, folder).toArrow().to_pylist()
    key = lambda r: tuple(str(r[k]) for k in sorted(r))
    assert sorted(map(key, mine)) == sorted(map(key, theirs))


def test_pipeline(spark, folder):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    docs = documents(spark, folder)
    frame = docs
    kept = [frame.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = shared.spill(stage(spark, frame, folder))
        assert frame.columns == docs.columns
        kept.append(frame.count())
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] == kept[4] > 0
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in frame.collect()}
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w", r["text"]) for r in frame.collect())


def test_word_tables_are_bounded_in_bytes_and_freed(spark):
    from stormspan.llm import packing, shared

    table = shared.Bounded(lambda k: k.encode() * 10, 100_000)
    for k in range(5000):
        assert table[f"w{k}"] == f"w{k}".encode() * 10
        assert table.held <= 100_000
    assert 0 < len(table) < 5000
    assert table["x" * 50_000] and "x" * 50_000 not in table

    def left(batches):
        import pyarrow as pa

        for _ in batches:
            pass
        words = packing.word_ids(packing.public_tokenizers.path(packing.VOCABULARY))
        yield pa.RecordBatch.from_arrays([pa.array([len(words.words) + len(words.pieces)])], ["left"])

    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('some words of ', id) AS text").coalesce(1)
    packing.pack(docs).collect()  # the same worker is used again below
    assert docs.select("doc_id").mapInArrow(left, "left long").first()[0] == 0
