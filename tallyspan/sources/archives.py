"""Zipped XML as a data source of Spark's: members of archives are dealt to partitions by size, records are streamed."""

from __future__ import annotations

import hashlib
import xml.parsers.expat
import zipfile
import zlib
from collections.abc import Iterator
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyspan.session import materialize

#: Bytes that are read at a time.
CHUNK = 1 << 16
#: What opening an archive or a member counts, and the most that a partition of several holds, in packed bytes.
OPEN_COST, PART_BYTES = 1 << 16, 1 << 24


def _open(uri: str) -> Any:
    """A seekable file of any store that Arrow knows (a plain path is local)."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return store.open_input_file(path)


class Members(InputPartition):
    """Pairs of an archive and a member; a member None stands for all of its archive."""

    def __init__(self, items: list[tuple[str, str | None]]):
        super().__init__(items)
        self.items = items


class _Records:
    """Fields of the record that is open: the text of each leaf by its path within the record."""

    def __init__(self, tag: str):
        self.tag, self.path, self.fields, self.text, self.leaf, self.done = tag, [], None, "", False, []

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if self.fields is None:
            if tag == self.tag:
                self.fields, self.path = {}, []
        else:
            self.path.append(tag)
        self.text, self.leaf = "", True

    def words(self, data: str) -> None:
        if self.fields is not None:
            self.text += data

    def closed(self, tag: str) -> None:
        if self.fields is None:
            return
        if not self.path:
            self.done.append(self.fields)
            self.fields = None
            return
        if self.leaf and self.text.strip():
            self.fields.setdefault("/".join(self.path), self.text.strip())
        self.path.pop()
        self.text, self.leaf = "", False


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.archives = [p for p in options["archives"].split("\n") if p]
        self.lengths = [int(n) for n in options.get("lengths", "").split("\n") if n]
        self.record = options["record"]
        self.parts = int(options.get("parts", 64))

    def partitions(self) -> list[Members]:
        """About ``parts`` of them, more where one would hold over ``PART_BYTES``.

        Archives that are known to be small are dealt whole and not opened here;
        of the others the directory is read, and their members are dealt. An
        archive that is none is dealt whole.
        """
        lengths = self.lengths or [PART_BYTES] * len(self.archives)
        share = min(PART_BYTES, sum(n + OPEN_COST for n in lengths) // self.parts)
        sized: list[tuple[int, tuple[str, str | None]]] = []
        for a, n in zip(self.archives, lengths, strict=True):
            if n + OPEN_COST <= share:
                sized.append((n + OPEN_COST, (a, None)))
                continue
            try:
                with _open(a) as f, zipfile.ZipFile(f) as z:
                    sized += [(i.compress_size + OPEN_COST, (a, i.filename)) for i in z.infolist() if not i.is_dir()]
            except (zipfile.BadZipFile, ValueError):  # Arrow's error for a file too short to hold a directory
                sized.append((OPEN_COST, (a, None)))
        share = min(PART_BYTES, sum(n for n, _ in sized) // self.parts)
        out, held = [], 0
        for n, item in sized:
            if not out or held + n > share:
                out.append(Members([]))
                held = 0
            out[-1].items.append(item)
            held += n
        return out

    def read(self, partition: Members) -> Iterator[tuple]:
        for archive, own in groupby(partition.items, key=lambda x: x[0]):
            wanted = [m for _, m in own]
            try:
                with _open(archive) as f, zipfile.ZipFile(f) as z:
                    for member in [i.filename for i in z.infolist() if not i.is_dir()] if wanted == [None] else wanted:
                        yield from self._member(archive, member, z)
            except (zipfile.BadZipFile, ValueError) as e:
                for member in wanted:
                    yield (archive, member or "", None, None, None, type(e).__name__)

    def _member(self, archive: str, member: str, z: zipfile.ZipFile) -> Iterator[tuple]:
        """The records of a member, then one row for the member itself with its digest, or with what is wrong with it."""
        found, digest, n, error = _Records(self.record), hashlib.sha256(), 0, None
        parser = xml.parsers.expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = found.opened, found.closed, found.words
        try:
            with z.open(member) as m:
                while True:
                    data = m.read(CHUNK)
                    digest.update(data)
                    parser.Parse(data, not data)
                    for fields in found.done:
                        n += 1
                        yield (archive, member, n, fields, None, None)
                    found.done.clear()
                    if not data:
                        break
        except (zipfile.BadZipFile, KeyError, EOFError, ValueError, zlib.error, xml.parsers.expat.ExpatError) as e:
            error = type(e).__name__
        yield (archive, member, None, None, None if error else digest.hexdigest(), error)


class ZippedXml(DataSource):
    """``spark.read.format("zipped_xml")`` with ``archives`` (paths, one a line), ``record`` (the element of a record), and if known ``lengths`` (bytes, one a line)."""

    @classmethod
    def name(cls) -> str:
        return "zipped_xml"

    def schema(self) -> str:
        return "archive string, member string, no int, fields map<string,string>, sha256 string, error string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_master_data(spark: SparkSession, folder: str, record: str, pattern: str = "*.zip") -> tuple[DataFrame, DataFrame]:
    """``(records, members)`` of the archives of a folder.

    ``records`` ``(archive, member, no, fields)`` are those of whole members;
    ``members`` has each member's digest and ``state``: whole or torn. A torn
    member's records are all kept out. Archives are listed by Spark, so any
    store that it reads may hold them; a task reads many small archives, or some
    members of a large one.
    """
    spark.dataSource.register(ZippedXml)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    found = sorted((r.path, r.length) for r in listed.collect())  # names and lengths of archives, not of members or records
    paths, lengths = ("\n".join(str(x[i]) for x in found) for i in (0, 1))
    read = spark.read.format("zipped_xml").option("archives", paths).option("lengths", lengths).option("parts", max(64, 3 * spark.sparkContext.defaultParallelism))
    rows = materialize(read.option("record", record).load(), "zipped-xml")
    members = rows.filter("no is null").select("archive", "member", "sha256", "error", F.when(F.col("error").isNull(), "whole").otherwise("torn").alias("state"))
    whole = members.filter("state = 'whole'").select("archive", "member")
    return rows.filter("no is not null").select("archive", "member", "no", "fields").join(whole, ["archive", "member"], "left_semi"), members
