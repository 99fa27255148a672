import hashlib
import random
import zlib

from dialoom.llm import interleave

from .helpers import documents, edge_texts

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><nav>menu</nav><article><h1>Head</h1><p>one &amp; <b>two</b></p>
<figure><img src="sha256:abc" alt="alt"><figcaption>A <i>caption</i></figcaption></figure><p>three<img src="/x.png" alt="pic">four</p>
<script>var t="<p>";</script></article></body></html>"""


def test_items_stay_in_order():
    items = interleave.parse_page(PAGE)
    assert [(i[0], i[1], i[2], i[4]) for i in items] == [
        ("text", "Head", None, None),
        ("text", "one & two", None, None),
        ("media", None, "sha256:abc", "A caption"),
        ("text", "three", None, None),
        ("media", None, "/x.png", "pic"),
        ("text", "four", None, None),
    ]
    assert items[2][3] == "abc" and items[4][3] == hashlib.sha256(b"/x.png").hexdigest()


def test_png_round_trip():
    rng = random.Random(0)
    for n in (1, 2, 17):
        raw = bytes(rng.randrange(256) for _ in range(64 * n))
        assert interleave.from_png(interleave.to_png(raw)) == raw


def test_documents(spark):
    texts = edge_texts() + ["<b>not markup</b> & so\n\nlast line"]
    df = documents(spark, texts, extra=True)
    facts = interleave.media_facts(interleave.store_media(df))
    assert facts.count() == len({t or "" for t in texts})
    items = interleave.page_items(interleave.document_pages(df))
    rows = {r["doc_id"]: r for r in interleave.resolve(items, facts).where("kind = 'media'").collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        pad = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
        assert r["media_sha256"] == hashlib.sha256(interleave.to_png(pad)).hexdigest() and r["media_bytes"] == len(interleave.to_png(pad))
    assert rows[3]["feature"] == rows[4]["feature"]
    whole = {r["doc_id"]: r["items"] for r in interleave.sequences(interleave.resolve(items, facts)).collect()}
    assert [i["position"] for i in whole[12]] == list(range(len(whole[12])))
    assert [i["text"] for i in whole[12] if i["kind"] == "text"] == ["<b>not markup</b> & so", "last line"]


def test_pages_and_missing_media(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")
    facts = interleave.media_facts(interleave.store_media(documents(spark, ["x"])))
    rows = interleave.resolve(interleave.page_items(pages), facts).collect()
    assert {r["doc_id"] for r in rows} == {1} and all(r["payload_sha256"] is None for r in rows) and len(rows) == 6
    assert interleave.page_items(pages.limit(0)).count() == 0


def shown(page):
    return [(i[0], i[1] or i[2], i[4]) for i in interleave.parse_page(page)]


def test_captions_and_missing_end_tags():
    a = ("media", "a", "cap")
    assert shown("<figure><figcaption>cap</figcaption><img src=a></figure>x") == [a, ("text", "x", None)]
    assert shown("<figure><img src=a><figcaption>cap</figure>x") == [a, ("text", "x", None)]
    assert shown("<div><figure><img src=a><figcaption>cap</div>x") == [a, ("text", "x", None)]
    assert shown("<figure><img src=a></figure><img src=b><figcaption>stray</figcaption>x") == [("media", "a", None), ("media", "b", None), ("text", "stray", None), ("text", "x", None)]
    assert shown("<figure><figure><img src=a><figcaption>cap</figcaption></figure><img src=b><figcaption>out</figcaption></figure>") == [a, ("media", "b", "out")]
    for page in ("<body><div><nav>menu</div><p>x</p></body>", "<nav>menu<article><p>x</p></article>", "<head><title>t<body>x", "<nav><figure><img src=q></nav>x"):
        assert shown(page) == [("text", "x", None)]
    assert shown("one</div>two<p>three<p>four") == [("text", t, None) for t in ("one", "two", "three", "four")]
    assert len(shown("<b>" * 30_000 + "x" + "</i>" * 30_000)) == 1


def test_clashing_size_column(spark):
    pages = spark.createDataFrame([(1, PAGE, "big")], "page_id long, html string, size string")
    assert {r["n_bytes"] for r in interleave.page_items(pages).collect()} == {len(PAGE.encode())}


def test_result_speaks_for_the_whole_sequence(spark):
    df = documents(spark, ["head\none\ntwo", "head\none\ntwx", "head\none\ntwo"])
    rows = interleave.page_items(interleave.document_pages(df), only_media=True).orderBy("doc_id").collect()
    assert [(r["n_items"], r["n_texts"]) for r in rows] == [(4, 3)] * 3
    assert rows[0]["sequence_sha256"] == rows[2]["sequence_sha256"] != rows[1]["sequence_sha256"]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = interleave.op1_interleaved_media(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        pad = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
        stored = interleave.to_png(pad)
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(stored), hashlib.sha256(stored).hexdigest(), interleave.feature_of(pad))
    pages = interleave.page_sequences(spark, sf).collect()
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for page, text in source.items():
        got = sorted((r for r in pages if r["page_id"] == page), key=lambda r: r["position"])
        assert [(r["kind"], r["text"], r["ref"], r["caption"]) for r in got] == [(i[0], i[1], i[2], i[4]) for i in interleave.parse_page(text or "")]
