"""Web archive files (ISO 28500) and the main text of their pages."""

from __future__ import annotations

import gzip
import html as entities
import io
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCKS = set("p div h1 h2 h3 h4 h5 h6 li td th tr ul ol dl dt dd table section article header footer main aside nav blockquote pre form br hr body title figcaption".split())
_SKIPPED = set("script style noscript template svg head".split())


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record of one archive file, gzipped or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    stream = io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a record of a web archive")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(warc_id, url, html) of the responses in the archive files below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = []
                for headers, body in records(content):
                    if headers.get("warc-type") == "response":
                        page = body.partition(b"\r\n\r\n")[2]
                        rows.append({"warc_id": headers.get("warc-record-id"), "url": headers.get("warc-target-uri"), "html": page.decode("utf-8", "replace")})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("warc_id", pa.string()), ("url", pa.string()), ("html", pa.string())]))

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(path)
    return listed.select("content").mapInArrow(run, "warc_id string, url string, html string")


def write_pages(pages: DataFrame, path: str) -> None:
    """Writes (warc_id, url, html) as archive files, one for each partition, by way of Hadoop's file system."""
    from loamline.sources.blobs import write_blobs

    def pack(number: int, rows: Iterator[dict]) -> Iterator[tuple[str, bytes]]:
        out = io.BytesIO()
        for r in rows:
            body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + r["html"].encode()
            out.write(f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {r['warc_id']}\r\nWARC-Target-URI: {r['url']}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
        yield f"part-{number:05d}.warc.gz", gzip.compress(out.getvalue())

    write_blobs(pages, path, pack)


class _Blocks(HTMLParser):
    """The text of a page by block, with the share of it that is inside links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int]] = []
        self.text: list[str] = []
        self.linked = self.skip = self.links = 0

    def flush(self) -> None:
        said = re.sub(r"\s+", " ", "".join(self.text)).strip()
        if said:
            self.blocks.append((said, self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self.flush()
        self.skip += tag in _SKIPPED
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        self.skip = max(0, self.skip - (tag in _SKIPPED))
        self.links = max(0, self.links - (tag == "a"))

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.text.append(data)
            self.linked += len(data) if self.links else 0


def extract(page: str | None, least: int = 25) -> str | None:
    """The blocks of a page that are prose: long enough, or with an end of a sentence, and not mostly links."""
    if page is None:
        return None
    parser = _Blocks()
    try:
        parser.feed(page)
        parser.close()
        parser.flush()
    except Exception:  # a page that can't be parsed
        return entities.unescape(re.sub(r"<[^>]*>", " ", page)).strip()
    good = [t for t, linked in parser.blocks if linked <= 0.5 * len(t) and (len(t) >= least or t[-1] in ".!?。！？")]
    return "\n".join(good)


def main_text(page: Column | str) -> Column:
    """The main text of a page of HTML."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(extract)

    return F.pandas_udf(run, "string")(page)
