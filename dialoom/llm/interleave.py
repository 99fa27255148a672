"""Interleaved document sequences: ordered text and media references of pages, joined to stored media.

A page's HTML becomes one ordered sequence of items, texts and media references. A reference names its
payload by digest; media live once in a content-addressed table, stored losslessly (8-bit grey PNG). A
join on the digest gives each reference the facts of its payload, and items go back to their positions
with their captions, so a reference that finds nothing keeps its place with null facts.
"""

from __future__ import annotations

import hashlib
import html
import json
import struct
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, map_arrow, materialise, struct_of, table, texts

#: Samples in a row of a stored picture; payloads are padded to a multiple of it.
WIDTH = 64
CAPTION_CHARS = 80

_SKIP = {"script", "style", "template", "noscript", "head", "nav"}
_BLOCK = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "br", "hr", "header", "footer", "main", "body", "aside"}
_MEDIA = {"img", "video", "audio", "source", "embed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements whose beginning ends others that were left open.
_ENDS = {"body": {"head"}, **dict.fromkeys(("main", "article", "section", "footer", "aside"), {"nav", "head"}), "figure": {"figcaption"}, "p": {"p"}, "li": {"li"}, "tr": {"tr", "td"}, "td": {"td"}}
_PNG = b"\x89PNG\r\n\x1a\n"


class _Figure:
    def __init__(self):
        self.media: list[list] = []
        self.caption: list[str] = []


class _Sequence(HTMLParser):
    """Collects ``[kind, text, ref, digest, caption]`` items in page order.

    Open elements are a stack: an end tag ends what is open inside its element, an end tag of nothing does
    nothing, so a forgotten end tag reaches no further than the element around it. A figure's caption, before
    or behind its media, goes to all of them when the figure ends; a caption outside a figure is text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self._text: list[str] = []
        self._open: list[str] = []
        self._named: Counter = Counter()
        self._skip = 0
        self._figures: list[_Figure] = []
        self._captions = 0

    def _flush(self) -> None:
        words = "".join(self._text).strip()
        self._text = []
        if words:
            self.items.append(["text", words, None, None, None])

    def _leave(self, depth: int) -> None:
        """End all open elements from this depth on."""
        while len(self._open) > depth:
            tag = self._open.pop()
            self._named[tag] -= 1
            if tag in _SKIP:
                self._skip -= 1
            elif tag == "figcaption":
                self._captions -= 1
            elif tag == "figure" and not self._skip:
                figure = self._figures.pop()
                caption = " ".join("".join(figure.caption).split())
                for item in figure.media:
                    item[4] = caption or item[4]
            if tag.removeprefix("plain ") in _BLOCK and not self._skip and not self._captions:
                self._flush()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ended = _ENDS.get(tag)
        if ended and self._open and self._open[-1] in ended:
            self._leave(len(self._open) - 1)
        elif tag in ("main", "article", "body", "footer") and self._skip:
            for depth, name in enumerate(self._open):
                if name in ("nav", "head"):  # never closed: content that begins ends it
                    self._leave(depth)
                    break
        caption = tag == "figcaption" and self._figures and not self._skip
        if tag in _BLOCK and not self._skip and not self._captions:
            self._flush()
        if tag in _SKIP:
            self._skip += 1
        if tag not in _VOID:
            # a caption outside a figure, and a figure that is passed over, are but blocks
            name = f"plain {tag}" if (tag == "figcaption" and not caption) or (tag == "figure" and self._skip) else tag
            self._open.append(name)
            self._named[name] += 1
        if self._skip:
            return
        if tag == "figure":
            self._figures.append(_Figure())
        elif caption:
            self._captions += 1
        elif tag in _MEDIA:
            a = dict(attrs)
            ref = a.get("src") or ""
            digest = a.get("data-digest") or ref.removeprefix("sha256:") * ref.startswith("sha256:") or None
            if not self._captions:
                self._flush()
            item = ["media", None, ref, digest or hashlib.sha256(ref.encode("utf-8", "surrogatepass")).hexdigest(), a.get("alt") or None]
            self.items.append(item)
            if self._figures:
                self._figures[-1].media.append(item)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in self._open[-1:] and tag not in _VOID:
            self._leave(len(self._open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            if tag in _BLOCK and not self._skip and not self._captions:
                self._flush()
            return
        for name in (tag, f"plain {tag}"):
            if self._named[name]:
                depth = len(self._open) - 1
                while self._open[depth] != name:
                    depth -= 1
                self._leave(depth)
                return
        if tag in _BLOCK and not self._skip and not self._captions:
            self._flush()

    def handle_data(self, data: str) -> None:
        if self._skip:
            return
        (self._figures[-1].caption if self._captions else self._text).append(data)

    def close(self) -> None:
        super().close()
        self._leave(0)
        self._flush()


def parse_page(page: str) -> list[list]:
    """Items of a page in order; text outside blocks counts, scripts, styles and navigation do not."""
    parser = _Sequence()
    parser.feed(page)
    parser.close()
    return parser.items


def to_png(samples: bytes) -> bytes:
    """Samples, a positive multiple of WIDTH, as an 8-bit grey picture of WIDTH columns."""
    rows = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH)
    plain = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(plain, 1)) + chunk(b"IEND", b"")


def from_png(stored: bytes) -> bytes:
    """The samples of such a picture; checks every chunk."""
    if stored[:8] != _PNG:
        raise ValueError("not a PNG")
    at, data, width = 8, [], 0
    while at < len(stored):
        (size,) = struct.unpack_from(">I", stored, at)
        kind, body = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", stored, at + 8 + size)[0]:
            raise ValueError("damaged chunk")
        if kind == b"IHDR":
            width, _, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if (depth, colour, interlace) != (8, 0, 0):
                raise ValueError("not an 8-bit grey picture")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, width + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows are not written here")
    return rows[:, 1:].tobytes()


def payload_of(text: str) -> bytes:
    """UTF-8 with zeros up to a positive multiple of WIDTH bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % WIDTH if raw else WIDTH)


def feature_of(samples: bytes) -> str:
    """Mean, deviation and an 8 by 8 brightness pattern of a picture."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    edges = np.linspace(0, len(x), 65).astype(int)
    sums = np.add.reduceat(np.r_[x, 0], np.minimum(edges[:-1], len(x) - 1))
    cells = sums / np.maximum(np.diff(edges), 1)
    bits = int("".join("1" if c > x.mean() else "0" for c in cells), 2)
    return f"{x.mean():.4f}:{x.std():.4f}:{bits:016x}"


MEDIA = struct_of("digest string, media binary")
FACTS = struct_of("digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
ITEMS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_items", T.IntegerType()),
        T.StructField("n_texts", T.IntegerType()),
        T.StructField("sequence_sha256", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("caption", T.StringType()),
    ]
)


def store_media(docs: DataFrame) -> DataFrame:
    """``digest, media``: every text's payload as a stored picture under the payload's SHA-256.

    Null and empty texts are WIDTH zeros; equal texts give equal rows; an empty table none; only ``text`` is read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        payloads = [payload_of(t) for t in texts(batch)]
        cols = [pa.array([hashlib.sha256(p).hexdigest() for p in payloads]), pa.array([to_png(p) for p in payloads], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(MEDIA))

    return map_arrow(docs.select("text"), run, MEDIA)


def media_facts(media: DataFrame) -> DataFrame:
    """One row per digest: what the stored bytes hold when read back. Damaged media are an error, rows with nulls too."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for digest, stored in zip(*(batch.column(c).to_pylist() for c in ("digest", "media")), strict=True):
            samples = from_png(stored)
            rows.append((digest, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(samples)))
        out = arrow_schema(FACTS)
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

    facts = map_arrow(media.select("digest", "media"), run, FACTS)
    # equal digests hold equal bytes: a minimum of each column keeps one row, summed before the shuffle
    return facts.groupBy("digest").agg(*(F.min(c).alias(c) for c in FACTS.names[1:]))


def sequence_digest(items: list[list]) -> str:
    """SHA-256 of a sequence: kinds, texts, digests and captions in order."""
    return hashlib.sha256(json.dumps([[i[0], i[1], i[3], i[4]] for i in items], ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()


def page_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", only_media: bool = False, size_col: str = "_size") -> DataFrame:
    """Items of each page: ``doc_id, row, n_bytes, n_items, n_texts, sequence_sha256, position, kind, text, ref, digest, caption``.

    ``n_items``, ``n_texts`` and ``sequence_sha256`` stand for the whole sequence, also with ``only_media``, which
    leaves texts out of the rows. ``n_bytes`` is the page's size, or ``size_col`` where there is such a column. ``row`` tells
    apart rows that share an id; null and empty pages have no item; other columns are not read, so names that
    clash do no harm. Unclosed elements end with the element around them.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, row, size, page in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "size", "page")), strict=True):
            items = parse_page(page or "")
            whole = (doc, row, size, len(items), sum(i[0] == "text" for i in items), sequence_digest(items))
            rows += [(*whole, k, *item) for k, item in enumerate(items) if not only_media or item[0] == "media"]
        out = arrow_schema(ITEMS)
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(out)], schema=out)

    size = F.col(size_col).cast("long") if size_col in pages.columns else F.octet_length(html_col).cast("long")
    chosen = pages.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), size.alias("size"), F.col(html_col).cast("string").alias("page"))
    return map_arrow(chosen, run, ITEMS)


def resolve(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Items with the facts of their payloads; references that find none, and texts, get nulls.

    Texts, which have no digest, do not enter the join. ``facts`` has a row a digest; a digest that very many
    references share is split by adaptive execution where ``facts`` is a written table. An empty table on
    either side is no error.
    """
    named = facts.withColumnRenamed("digest", "_digest")
    found = items.where("digest is not null").join(named, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    rest = items.where("digest is null")
    return found.unionByName(rest, allowMissingColumns=True)


def sequences(resolved: DataFrame) -> DataFrame:
    """One row per page with an item: ``doc_id, items``, the structs in page order; rows that share an id stay apart."""
    names = [c for c in resolved.columns if c not in ("doc_id", "row", "n_items", "n_texts", "sequence_sha256")]
    packed = resolved.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("position", *(c for c in names if c != "position")))).alias("items"))
    return packed.select("doc_id", "items")


def page_of(text: str) -> str:
    """A document as a page: its first line, the picture of its payload with a caption, the other lines."""
    first, _, rest = text.partition("\n")
    lines = "".join(f"<p>{html.escape(line, False)}</p>" for line in rest.split("\n")) if rest else ""
    caption = html.escape(" ".join(first.split())[:CAPTION_CHARS], False)
    digest = hashlib.sha256(payload_of(text)).hexdigest()
    picture = f'<figure><img src="sha256:{digest}"><figcaption>{caption}</figcaption></figure>'
    return f"<article><p>{html.escape(first, False)}</p>{picture}{lines}</article>"


PAGE = struct_of("page_id long, _size long, html string")


def document_pages(docs: DataFrame) -> DataFrame:
    """``page_id, _size, html`` of every document, ``_size`` being the bytes of its text; null texts are empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = texts(batch)
        cols = [batch.column("doc_id"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in rows]), pa.array([page_of(t) for t in rows], pa.string())]
        return pa.RecordBatch.from_arrays(cols, schema=arrow_schema(PAGE))

    return map_arrow(docs.select("doc_id", "text"), run, PAGE)


def op1_interleaved_media(spark, sf_dir: str) -> DataFrame:
    """Every document as a page, its payload as stored media; the page's sequence and the facts of its media.

    Null and empty texts give one row of zeros; repeated rows are answered each; an empty table gives none.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    facts = materialise(media_facts(materialise(store_media(docs), "media-store")), "media-facts")
    items = page_items(document_pages(docs), only_media=True)
    return resolve(items, facts).select("doc_id", "n_bytes", *FACTS.names[1:], "n_items", "n_texts", "sequence_sha256", "position", "caption")


def page_sequences(spark, sf_dir: str) -> DataFrame:
    """The sequences of the raw ``pages``, a row an item. Their media are not stored here, so they have no facts."""
    items = page_items(table(spark, sf_dir, "pages"))
    return items.select(F.col("doc_id").alias("page_id"), "position", "kind", "text", "ref", "caption", "n_items")
