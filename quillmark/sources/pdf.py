"""Import of text layers of PDF files: a row per page, files read as Spark reads them, parsed where they lie.

Objects are found by scanning, so a broken cross-reference table does no harm; streams may be deflated, objects
may lie in object streams, and characters are named by a font's ToUnicode map (else they are Latin-1). Text
comes in the order in which a page's content shows it. Pictures have no text: no OCR is done.

Defined cases: a null or empty file, one without pages and an encrypted one give one row with page 0, an empty text and a
fault. A page whose content can't be read has an empty text and that fault, the others theirs. Repeated files give repeated rows
(with a cache, too). Pages keep NULs; ``clean_text`` takes them out where pages become documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.text import clean_text
from quillmark.functions.workers import ship

PAGES = "sha256 string, page int, text string, fault string"
#: A kern of so many thousandths of a letter's height is a space between words.
SPACE = 200
TOKEN = re.compile(rb"[\x00\t\n\f\r ]+|%[^\r\n]*|(<<|>>|[\[\]{}])|\(|<([0-9A-Fa-f\s]*)>|(/[^\x00\t\n\f\r ()<>\[\]{}/%]*)|([^\x00\t\n\f\r ()<>\[\]{}/%]+)")
START = re.compile(rb"(?<![0-9])(\d+)\s+(\d+)\s+obj\b")
NUMBER = re.compile(rb"[+-]?(?:\d+\.?\d*|\.\d+)\Z")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
IN_STRING = re.compile(rb"\\([0-7]{1,3}|\r\n|[\s\S])|[()]")


class Name(str):
    """A name, as in /Type."""


class Ref(int):
    """The number of an object that stands here."""


class Word(bytes):
    """An operator or another bare word."""


def _string(data: bytes, at: int) -> tuple[bytes, int]:
    """The string in brackets that begins before ``at``, and where it ends."""
    parts, depth, start = [], 1, at
    for m in IN_STRING.finditer(data, at):
        if m[0] in b"()":
            depth += 1 if m[0] == b"(" else -1
            if not depth:
                return b"".join([*parts, data[start : m.start()]]), m.end()
            continue
        own = m[1]
        code = bytes([int(own, 8) & 255]) if own[:1] in b"01234567" else b"" if own in (b"\r\n", b"\r", b"\n") else ESCAPES.get(own, own)
        parts += [data[start : m.start()], code]
        start = m.end()
    return b"".join([*parts, data[start:]]), len(data)


def tokens(data: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Tokens and where they end: bytes, Name, Word, numbers."""
    while at < len(data):
        m = TOKEN.match(data, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        if m[0] == b"(":
            text, at = _string(data, at)
            yield text, at
        elif m[2] is not None:
            digits = b"".join(m[2].split())
            yield bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()), at
        elif m[3]:
            yield Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes.fromhex(h[1].decode()), m[3][1:]).decode("latin-1")), at
        elif m[1]:
            yield Word(m[1]), at
        elif m[4]:
            yield (float(m[4]) if b"." in m[4] else int(m[4])) if NUMBER.match(m[4]) else Word(m[4]), at


def value(data: bytes, at: int = 0) -> tuple[object, int]:
    """The object that begins here, and where it ends; dictionaries and arrays may nest to any depth."""
    open_: list[list] = [[]]
    kinds: list[bytes] = []
    for token, at in tokens(data, at):
        if isinstance(token, Word):
            if token in (b"<<", b"["):
                open_.append([])
                kinds.append(bytes(token))
                continue
            if token in (b">>", b"]") and kinds:
                items = open_.pop()
                made = items if kinds.pop() == b"[" else {k: v for k, v in zip(items[::2], items[1::2], strict=False) if isinstance(k, Name)}
                open_[-1].append(made)
            elif token == b"R" and len(open_[-1]) > 1 and isinstance(open_[-1][-2], int):
                open_[-1].pop()
                open_[-1].append(Ref(open_[-1].pop()))
            elif token in (b"endobj", b"stream"):
                break
            else:
                open_[-1].append({b"true": True, b"false": False}.get(bytes(token)))
        else:
            open_[-1].append(token)
        follows = isinstance(open_[-1][-1], int) and re.compile(rb"\s+\d+\s+R\b").match(data, at) or isinstance(token, int) and re.compile(rb"\s+R\b").match(data, at)
        if not kinds and not follows:
            break
    return (open_[0][0] if open_[0] else None), at


class File:
    """The objects of a file, by number."""

    def __init__(self, data: bytes) -> None:
        self.objects: dict[int, object] = {}
        self.bodies: dict[int, bytes] = {}
        self.encrypted = re.search(rb"/Encrypt\s+(?:\d+\s+\d+\s+R|<<)", data) is not None
        at = 0
        while m := START.search(data, at):
            number = int(m[1])
            self.objects[number], at = value(data, m.end())
            head = re.compile(rb"\s*(?:stream)?\r?\n?").match(data, at) if isinstance(self.objects[number], dict) else None
            if head and b"stream" in head[0]:
                length = self.objects[number].get("Length")
                end = head.end() + length if isinstance(length, int) and not isinstance(length, Ref) else -1
                if end < 0 or not re.compile(rb"\s*endstream").match(data, end):
                    end = data.find(b"endstream", head.end())
                    end = len(data) if end < 0 else end
                self.bodies[number], at = data[head.end() : end], end
        if not self.encrypted:
            for number in [n for n, o in self.objects.items() if isinstance(o, dict) and o.get("Type") == "ObjStm" and n in self.bodies]:
                body, about = self.body(number), self.objects[number]
                heads = [t for t, _ in tokens(body[: int(self.get(about.get("First")))])]
                for inner, offset in zip(heads[::2], heads[1::2], strict=False):
                    self.objects.setdefault(inner, value(body, self.get(about["First"]) + offset)[0])

    def get(self, o: object) -> object:
        seen = 0
        while isinstance(o, Ref) and seen < 32:
            o, seen = self.objects.get(int(o)), seen + 1
        return o

    def body(self, number: int) -> bytes:
        body, filters = self.bodies.get(number, b""), self.get(self.objects[number].get("Filter"))
        for f in filters if isinstance(filters, list) else [filters] if filters else []:
            if self.get(f) not in ("FlateDecode", "Fl"):
                raise ValueError(f"filter {f}")
            body = zlib.decompressobj().decompress(body)
        return body

    def pages(self) -> list[dict]:
        """The pages in their order, with the resources that they inherit."""
        roots = [o for o in self.objects.values() if isinstance(o, dict) and o.get("Type") == "Catalog"]
        found, todo, seen = [], [(roots[-1].get("Pages"), {})] if roots else [], set()
        while todo:
            ref, inherited = todo.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or (isinstance(ref, Ref) and ref in seen):
                continue
            seen.add(ref if isinstance(ref, Ref) else None)
            resources = self.get(node.get("Resources")) or inherited
            kids = self.get(node.get("Kids"))
            if isinstance(kids, list):
                todo += [(k, resources) for k in reversed(kids)]
            else:
                found.append({**node, "Resources": resources})
        return found


def character_map(body: bytes) -> tuple[int, dict[int, bytes], list[tuple[int, int, int, int]]]:
    """A font's ToUnicode map: bytes a code, codes to UTF-16, and ranges (first, last, what the first is, its width)."""
    width, single, ranges, held = 1, {}, [], []
    for token, _ in tokens(body):
        if isinstance(token, Word) and token.startswith((b"begin", b"end")):
            if token == b"endcodespacerange" and held:
                width = len(held[0])
            elif token == b"endbfchar":
                single |= {int.from_bytes(a, "big"): b for a, b in zip(held[::2], held[1::2], strict=False)}
            elif token == b"endbfrange":
                i = 0
                while i + 2 < len(held):
                    low, high = int.from_bytes(held[i], "big"), int.from_bytes(held[i + 1], "big")
                    if held[i + 2] == b"[":
                        end = held.index(b"]", i)
                        single |= {low + j: v for j, v in enumerate(held[i + 3 : end])}
                        i = end + 1
                    else:
                        ranges.append((low, high, int.from_bytes(held[i + 2], "big"), len(held[i + 2])))
                        i += 3
            held = []
        elif isinstance(token, bytes):
            held.append(bytes(token))
    return width, single, ranges


def decoded(shown: bytes, font: tuple | None) -> bytes:
    """What a string shows, as UTF-16."""
    if font is None:
        return shown.decode("latin-1").encode("utf-16-be")
    width, single, ranges = font
    out = []
    for i in range(0, len(shown), width):
        code = int.from_bytes(shown[i : i + width], "big")
        if code in single:
            out.append(single[code])
            continue
        for low, high, first, size in ranges:
            if low <= code <= high:
                out.append((first + code - low).to_bytes(size, "big"))
                break
    return b"".join(out)


def page_text(file: File, page: dict) -> str:
    """The text that a page's content shows."""
    fonts: dict[str, tuple | None] = {}
    for name, ref in (file.get((page["Resources"] or {}).get("Font")) or {}).items():
        to = (file.get(ref) or {}).get("ToUnicode")
        fonts[name] = character_map(file.body(int(to))) if isinstance(to, Ref) and int(to) in file.bodies else None
    contents = page.get("Contents")
    listed = file.get(contents)
    parts = [file.body(int(r)) for r in (listed if isinstance(listed, list) else [contents]) if isinstance(r, Ref) and int(r) in file.bodies]
    out, held, font, row = [], [], None, None
    line, space = "\n".encode("utf-16-be"), " ".encode("utf-16-be")

    def show(parts: list) -> None:
        for p in parts:
            if isinstance(p, bytes) and not isinstance(p, Word):
                out.append(decoded(p, font))
            elif isinstance(p, int | float) and p < -SPACE and out and out[-1] not in (line, space):
                out.append(space)

    for token, _ in tokens(b"\n".join(parts)):
        if not isinstance(token, Word) or token in (b"[", b"]"):
            held.append(token)
            continue
        if token == b"Tf" and len(held) > 1:
            font = fonts.get(held[-2])
        elif token in (b"T*", b"'", b'"') or token in (b"Td", b"TD") and held and held[-1]:
            out += [line] if out else []
        elif token == b"Tm" and len(held) > 5:
            out += [line] if out and out[-1] != line and row not in (None, held[-1]) else []
            row = held[-1]
        elif token == b"BT":
            out += [line] if out and out[-1] != line else []
        if token in (b"Tj", b"TJ", b"'", b'"'):
            show(held)
        held = []
    return b"".join(out).decode("utf-16-be", "replace")


def parse(content: bytes | None) -> list[tuple[int, str, str | None]]:
    """(page, text, fault) of each page, from 1; page 0 where there is none."""
    try:
        file = File(bytes(content or b""))
        pages = [] if file.encrypted else file.pages()
    except (ValueError, TypeError, KeyError, zlib.error) as e:
        return [(0, "", f"broken: {e}")]
    made: list[tuple[int, str, str | None]] = []
    for i, page in enumerate(pages, 1):
        try:
            made.append((i, page_text(file, page), None))
        except (ValueError, TypeError, KeyError, AttributeError, zlib.error) as e:
            made.append((i, "", f"broken: {e}"))
    return made or [(0, "", "encrypted" if file.encrypted else "no pages")]


def pages_of(files: DataFrame) -> DataFrame:
    """sha256, page, text and fault of each page of files (sha256, content); a file at a time is in memory."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sha, content in zip(batch["sha256"], batch["content"], strict=True):
                page, text, fault = zip(*parse(content.as_py()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([sha.as_py()] * len(page), pa.string()), pa.array(page, pa.int32()), pa.array(text, pa.string()), pa.array(fault, pa.string())], names=["sha256", "page", "text", "fault"])

    return files.select("sha256", "content").mapInArrow(run, PAGES)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 and content of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "content")


def import_pdf(spark: SparkSession, path: str, cache: str | None = None) -> DataFrame:
    """path, sha256, page, text and fault of the files below a folder.

    A cache is a table of pages by the file's hash, as they were read: files in it aren't parsed again, new ones are added to it.
    """
    files = files_of(spark, path)
    if cache is None:
        return files.select("path", "sha256").join(pages_of(files.dropDuplicates(["sha256"])), "sha256").select("path", "sha256", "page", "text", "fault")
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.schema(PAGES).parquet(cache)
        new = files.join(known.select("sha256").distinct(), "sha256", "left_anti")
    else:
        new = files
    pages_of(new.dropDuplicates(["sha256"])).write.mode("append").parquet(cache)
    return files.select("path", "sha256").join(spark.read.schema(PAGES).parquet(cache), "sha256").select("path", "sha256", "page", "text", "fault")


def texts_of(pages: DataFrame, source_id: str) -> DataFrame:
    """source_id, path, text of each page that has a text, cleaned: rows that ``corpus.documents_of`` takes."""
    body = clean_text("text")
    return pages.where(F.trim(body) != "").select(F.lit(source_id).alias("source_id"), F.concat_ws("#", "path", F.col("page").cast("string")).alias("path"), body.alias("text"))


def as_pdf(lines: Column) -> Column:
    """A PDF of one page, as bytes, that shows an array of lines; made of DataFrame functions."""
    shown = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<"), F.hex(F.encode(x, "UTF-16BE")), F.lit("> Tj T*\n"))), "")
    content = F.concat(F.lit("BT /F1 12 Tf 14 TL 72 720 Td\n"), shown, F.lit("ET"))
    names = "/CIDInit /ProcSet findresource begin begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange endcmap end"
    stream = lambda n, c: F.concat(F.lit(f"{n} 0 obj\n<< /Length "), F.length(c).cast("string"), F.lit(" >>\nstream\n"), c, F.lit("\nendstream\nendobj\n"))
    head = "%PDF-1.7\n1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Type /Pages /Kids [3 0 R] /Count 1 >>\nendobj\n3 0 obj\n<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>\nendobj\n5 0 obj\n<< /Type /Font /Subtype /Type0 /BaseFont /F /Encoding /Identity-H /ToUnicode 6 0 R >>\nendobj\n"
    return F.concat(F.lit(head), stream(4, content), stream(6, F.lit(names)), F.lit("trailer\n<< /Root 1 0 R >>\n%%EOF\n")).cast("binary")
