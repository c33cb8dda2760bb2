"""WARC archives: pages are written, archives of one gzip stream are made seekable, records are read back by offset.

The normaliser inflates a whole-file stream once, from its first byte to its last, writes every record as a gzip member
of its own and a sidecar with the offset of each. A record that the list of revisits names loses its payload on the way:
it then points to the record that has it. Which records these are is worked out from digests alone, so that no payload
is shuffled; a task holds one record's header and a chunk of its block.

Archives lie in a folder that all executors reach, named by a URI that ``pyarrow.fs`` opens (file, hdfs, s3, gs). A task
that is run again writes files of new names; the index names those of the attempt that counted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import path_of
from .textops import discard, give_back, id_schema, join_counted, materialize, record_batch, shared_folder, typed

#: Bytes of records after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Payloads of fewer bytes are never replaced by a revisit.
LEAST_PAYLOAD = 1000
#: Bytes that are read, inflated or written at once; the longest header that a record may have.
CHUNK, LONGEST_HEADER = 1 << 20, 1 << 20
END = b"\r\n\r\n"
VERSION = "WARC/1.1"
#: Fixed value of the format: why a revisit has no payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64()), ("key", pa.binary())])
INDEX = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string())])
RECORDS = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_())])
INDEX_DDL = "file string, ordinal long, offset long, length long, record_type string, record_id string, target_uri string"
RECORDS_DDL = "file string, offset long, record_type string, record_id string, target_uri string, fields map<string,string>, payload binary, payload_bytes long, payload_digest string, intact boolean"


def opened(uri: str):
    """(file system, path) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def record_id(file: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{ordinal}')}>"


def head(fields: dict[str, str]) -> bytes:
    return "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items()), "\r\n"]).encode()


def fields_of(header: bytes) -> dict[str, str]:
    """The named fields of a record's header; raises ValueError if it is none."""
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def uri_of(url: str | None) -> str:
    """A url as a header takes it: blanks and control characters are escaped; null is about:blank."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def http_head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


class _Single:
    """An archive that is one gzip stream from end to end, as many crawlers leave it."""

    def __init__(self, folder: str, date: str):
        self.fs, at = opened(folder)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        self.fs.create_dir(at, recursive=True)
        self.out = self.fs.open_output_stream(f"{at}/{self.name}", compression=None)
        self.gzip, self.size, self.ordinal = zlib.compressobj(1, wbits=31), 0, 0
        self.date = date
        about = b"software: vigia\r\nformat: WARC File Format 1.1\r\n"
        self.put({"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields"}, [about])

    def put(self, fields: dict[str, str], block: list[bytes]) -> int:
        own = {"WARC-Type": fields.pop("WARC-Type"), "WARC-Record-ID": record_id(self.name, self.ordinal), "WARC-Date": self.date}
        for piece in (head(own | fields | {"Content-Length": str(sum(map(len, block)))}), *block, END):
            self.out.write(self.gzip.compress(piece))
            self.size += len(piece)
        self.ordinal += 1
        return self.ordinal - 1

    def close(self) -> None:
        self.out.write(self.gzip.flush())
        self.out.close()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a response record for each row of ``pages`` to archives of one gzip stream; gives id, file, ordinal, n, key.

    ``n`` is the payload's bytes, ``key`` its SHA-256. A null html is an empty payload, a null url about:blank, a null id
    is left out of the header. Repeated rows are records of their own; an empty table writes nothing.
    """

    def run(batches):
        archive = None
        for batch in batches:
            names, ordinals, sizes, keys = [], [], [], []
            for page, url, html in zip(*batch.columns, strict=True):
                if archive is None:
                    archive = _Single(folder, date)
                payload = (html.as_py() or "").encode()
                own = {"Page-Id": str(page.as_py())} if page.is_valid else {}
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                ordinals.append(archive.put({"WARC-Type": "response", "WARC-Target-URI": uri_of(url.as_py()), "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"} | own, [http_head(len(payload)), payload]))
                names.append(archive.name)
                sizes.append(len(payload))
                keys.append(hashlib.sha256(payload).digest())
                if archive.size >= archive_bytes:
                    archive.close()
                    archive = None
            yield record_batch(typed(WRITTEN, batch), [batch.column(0), names, ordinals, sizes, keys])
            give_back()
        if archive is not None:
            archive.close()

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return materialize(rows.mapInArrow(run, id_schema(pages, id_col, "file string, ordinal long, n long, key binary")), "warc-written")


def revisits(records: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """file, ordinal, of_id, of_file, of_ordinal: the records that others replace. Of equal payloads of ``least`` bytes at least, that with
    the largest id stays (null ids last; of rows that share it, one). ``records`` is a written table of ``write_archives``."""
    large = records.where(F.col("n") >= least)
    kept = large.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("id", "file", "ordinal")).alias("of")).where("_n > 1")
    found = join_counted(large, kept, ["key"], "inner", records.count())
    return found.where((F.col("file") != F.col("of.file")) | (F.col("ordinal") != F.col("of.ordinal"))).select(
        "file", "ordinal", F.col("of.id").alias("of_id"), F.col("of.file").alias("of_file"), F.col("of.ordinal").alias("of_ordinal"))


class Inflated:
    """The bytes of an archive, inflated once, front to back: one gzip stream, many members, or plain."""

    def __init__(self, raw):
        self.raw, self.held, self.rest = raw, bytearray(), raw.read(CHUNK)
        self.gzip = zlib.decompressobj(31) if self.rest[:2] == b"\x1f\x8b" else None

    def more(self) -> bool:
        """Inflates another chunk; False at the end."""
        while True:
            if not self.rest:
                self.rest = self.raw.read(CHUNK)
            if not self.rest:
                if self.gzip is not None and not self.gzip.eof and self.started:
                    raise ValueError("the stream breaks off")
                return False
            if self.gzip is None:
                self.held += self.rest
                self.rest = b""
                return True
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(31)
            self.started = True
            out = self.gzip.decompress(self.rest, CHUNK)
            self.rest = self.gzip.unused_data if self.gzip.eof else self.gzip.unconsumed_tail
            if self.gzip.eof and not self.rest:
                self.started = False
            if out:
                self.held += out
                return True

    started = False

    def header(self) -> bytes | None:
        """Up to the next empty line; None at the end."""
        at = 0
        while (end := self.held.find(END, max(0, at - 3))) < 0:
            at = len(self.held)
            if at > LONGEST_HEADER:
                raise ValueError("a header without an end")
            if not self.more():
                if self.held.strip(b"\r\n"):
                    raise ValueError("the file ends in a header")
                return None
        found = bytes(self.held[: end + len(END)])
        del self.held[: end + len(END)]
        return found

    def block(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in chunks."""
        while n > 0:
            if not self.held and not self.more():
                raise ValueError("the file ends in a block")
            piece = bytes(self.held[:n])
            del self.held[:n]
            n -= len(piece)
            yield piece

    def gap(self) -> None:
        """Skips the empty lines after a record."""
        while True:
            k = len(self.held) - len(self.held.lstrip(b"\r\n"))
            del self.held[:k]
            if self.held or not self.more():
                return


def _http_split(block: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The HTTP header of a block, and the rest of it in chunks."""
    held = b""
    for piece in block:
        held += piece
        if (end := held.find(END)) >= 0:
            rest = held[end + len(END) :]
            return held[: end + len(END)], (x for part in ([rest], block) for x in part)
        if len(held) > LONGEST_HEADER:
            break
    return b"", (x for part in ([held], block) for x in part)


def rewritten(stream: Inflated, out, replaced: dict[int, tuple], name: str) -> Iterator[tuple]:
    """Writes each record of ``stream`` as a gzip member of ``out``; gives (ordinal, offset, length, type, id, uri) of each."""
    offset, ordinal = 0, 0
    while (header := stream.header()) is not None:
        fields = fields_of(header)
        block = stream.block(int(fields["Content-Length"]))
        if ordinal in replaced:
            of_id, of_file, of_ordinal = replaced[ordinal]
            http, rest = _http_split(block)
            for _ in rest:  # the payload stays behind
                pass
            fields |= {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(of_file, of_ordinal), "Content-Length": str(len(http))}
            fields |= {"Refers-To-Page-Id": str(of_id)} if of_id is not None else {}
            header, block = head(fields), [http]
        gzip, length = zlib.compressobj(6, wbits=31), 0
        for part in ([header], block, [END]):
            for piece in part:
                length += out.write(gzip.compress(piece))
        length += out.write(gzip.flush())
        yield ordinal, offset, length, fields.get("WARC-Type"), fields.get("WARC-Record-ID"), fields.get("WARC-Target-URI")
        offset, ordinal = offset + length, ordinal + 1
        stream.gap()


def normalise(archives: DataFrame, folder: str, replaced: DataFrame | None = None) -> DataFrame:
    """Rewrites archives (column ``file``: URIs) with a gzip member for each record; gives their index: file, ordinal, offset, length,
    record_type, record_id, target_uri. Beside each new archive lies its sidecar, ``.index.json``, with a line for each record.

    ``replaced`` (file, ordinal, of_id, of_file, of_ordinal) names records, by their file's last name, that become revisits. A file
    that breaks off keeps its records up to there and has one more row, of type 'damaged'; what was written of the broken record is not indexed. A file is one task, as a gzip
    stream can only be read from its start; no more than a chunk of it is held.
    """
    name = F.element_at(F.split("file", "/"), -1)
    rows = archives.select("file", name.alias("_name")).distinct()
    if replaced is None:
        rows = rows.withColumn("replaced", F.lit(None).cast("array<struct<ordinal:bigint,of_id:string,of_file:string,of_ordinal:bigint>>"))
    else:
        lists = replaced.groupBy(F.col("file").alias("_of")).agg(F.collect_list(F.struct("ordinal", F.col("of_id").cast("string").alias("of_id"), "of_file", "of_ordinal")).alias("replaced"))  # of one archive
        rows = rows.join(lists, F.col("_name") == F.col("_of"), "left")
    rows = materialize(rows.select("file", "replaced"), "warc-plan")

    def run(batches):
        for batch in batches:
            for file, lost in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                changes = {x["ordinal"]: (x["of_id"], x["of_file"], x["of_ordinal"]) for x in lost.as_py() or []}
                source, path = opened(file)
                target, at = opened(folder)
                target.create_dir(at, recursive=True)
                new = f"{uuid.uuid4().hex}.warc.gz"
                found, held = 0, []
                with source.open_input_stream(path, compression=None) as raw, target.open_output_stream(f"{at}/{new}", compression=None) as out, target.open_output_stream(f"{at}/{new}.index.json", compression=None) as sidecar:
                    try:
                        for row in rewritten(Inflated(raw), out, changes, new):
                            sidecar.write(json.dumps(dict(zip(INDEX.names[1:], row, strict=True))).encode() + b"\n")
                            held.append((f"{folder}/{new}", *row))
                            found += 1
                            if len(held) == 10_000:
                                yield record_batch(INDEX, list(zip(*held, strict=True)))
                                held = []
                    except (ValueError, KeyError, zlib.error):
                        held.append((f"{folder}/{new}", found, None, None, "damaged", None, None))
                if held:
                    yield record_batch(INDEX, list(zip(*held, strict=True)))
            give_back()

    index = materialize(rows.repartition(max(1, min(rows.count(), 10_000))).mapInArrow(run, INDEX_DDL), "warc-index")
    discard(rows)
    return index


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names: file, offset, record_type, record_id, target_uri, fields, payload (null without ``payloads``), payload_bytes,
    payload_digest (hexadecimal), intact. A record is read by its offset alone.

    The payload of an HTTP response is what follows its header. Bytes and digest are those of the payload itself; of a revisit
    they are those that its header gives, its payload is empty. ``intact`` says that payload and header agree.
    """

    def run(batches):
        held_name, held = None, None
        for batch in batches:
            out, size = [], 0
            for file, offset, length in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                if file != held_name:
                    if held is not None:
                        held.close()
                    fs, path = opened(file)
                    held_name, held = file, fs.open_input_file(path)
                held.seek(offset)
                record = zlib.decompress(held.read(length), wbits=31)
                header, _, block = record.partition(END)
                fields = fields_of(header)
                block = block[: int(fields["Content-Length"])]
                http, _, payload = block.partition(END) if fields.get("Content-Type", "").startswith("application/http") else (b"", b"", block)
                told = re.search(rb"(?i)^content-length: *(\d+)", http, re.M)
                digest = fields.get("WARC-Payload-Digest", "").partition(":")[2]
                said = base64.b32decode(digest).hex() if digest else None
                own = hashlib.sha1(payload).hexdigest()
                revisit = fields["WARC-Type"] == "revisit"
                n = int(told[1]) if revisit and told else len(payload)
                fine = not payload if revisit else said in (None, own)
                out.append((file, offset, fields["WARC-Type"], fields.get("WARC-Record-ID"), fields.get("WARC-Target-URI"), list(fields.items()), payload if payloads else None, n, said if revisit else own, fine))
                size += len(payload) if payloads else 0
                if size > CHUNK:
                    yield record_batch(RECORDS, list(zip(*out, strict=True)))
                    out, size = [], 0
            if out:
                yield record_batch(RECORDS, list(zip(*out, strict=True)))
            give_back()
        if held is not None:
            held.close()

    return index.where("offset is not null").select("file", "offset", "length").mapInArrow(run, RECORDS_DDL)


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` to seekable archives in ``folder``, equal payloads once; gives their index. Rows as in ``write_archives``."""
    spark, raw = pages.sparkSession, f"{folder.rstrip('/')}/raw-{uuid.uuid4().hex}"
    records = write_archives(pages, raw, id_col, url_col, html_col, archive_bytes=archive_bytes)
    files = records.select(F.concat(F.lit(f"{raw}/"), "file").alias("file"))
    index = normalise(files, folder.rstrip("/"), revisits(records, least))
    discard(records)
    remove(spark, raw)
    return index


def remove(spark: SparkSession, folder: str) -> None:
    fs, path = path_of(spark, folder)
    fs.delete(path, True)


def report(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """One row for each row of ``pages``, read back from its archive: id, payload_bytes, payload_digest, record_type, refers_to, intact.

    The archives are made in the shared folder and go when they are read.
    """
    kind = pages.schema[id_col].dataType
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    index = archive(pages, folder, id_col, url_col, html_col, least, archive_bytes)
    back = read(index.where("record_type in ('response', 'revisit')"), payloads=False)
    found = materialize(back.select(F.col("fields")["Page-Id"].cast(kind).alias("id"), "payload_bytes", "payload_digest", "record_type", F.col("fields")["Refers-To-Page-Id"].cast(kind).alias("refers_to"), "intact"), "warc-read")
    discard(index)
    remove(pages.sparkSession, folder)
    return found.withColumnRenamed("id", id_col)
