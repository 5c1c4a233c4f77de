"""``spark.read.format("feature_pages")``: captured page files as a data source, one task for each file.

Pages are named ``page_<offset>.geojson`` or ``.json`` after the number of features before them, so each task can tell alone
whether its page is whole: the next page begins where it ends, and the last one ends at the number that the layer declared.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "properties map<string,string>, geometry string, page string, at bigint"
_ARROW = pa.schema([("properties", pa.map_(pa.string(), pa.string())), ("geometry", pa.string()), ("page", pa.string()), ("at", pa.int64())])
_NAMED = re.compile(r"page_(\d+)\.(?:geo)?json$")


@dataclass
class Page(InputPartition):
    """A file, where its features begin, and how many it must hold (None if that is not known)."""

    uri: str
    path: str
    offset: int
    wanted: int | None


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a URI or absolute path; Hadoop writes local ones with a single slash."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "/", uri))


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


class PageReader(DataSourceReader):
    """Lists names on the driver; pages are opened, parsed and counted in tasks."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("feature_pages needs a path")
        self.uri = options["path"]
        self.declared = int(options["declared"]) if "declared" in options else None
        mode = options.get("mode", "FAILFAST").upper()
        if mode not in ("FAILFAST", "PERMISSIVE"):
            raise ValueError(f"unknown mode {mode}: FAILFAST or PERMISSIVE")
        self.strict = mode == "FAILFAST"

    def partitions(self) -> list[Page]:
        system, folder = _open(self.uri)
        names = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File]
        found = sorted((int(m.group(1)), p) for p in names if (m := _NAMED.search(p)))
        if self.strict and self.declared and (not found or found[0][0] > 0):
            raise ValueError(f"{self.uri}: the first page is missing")
        ends = [at for at, _ in found[1:]] + [self.declared]
        return [Page(self.uri, p, at, None if end is None else end - at) for (at, p), end in zip(found, ends, strict=False)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Page):  # a folder without pages has one empty task
            return
        system, _ = _open(partition.uri)
        with system.open_input_stream(partition.path) as stream:
            document = json.loads(stream.read())
        if self.strict and document.get("error"):
            raise ValueError(f"{partition.path} holds an error: {document['error']}")
        features = document.get("features") or []
        if self.strict and partition.wanted is not None and len(features) != partition.wanted:
            raise ValueError(f"{partition.path} has {len(features)} features, {partition.wanted} are declared")
        rows = [f.get("properties") or f.get("attributes") or {} for f in features]
        columns = [
            [[(k, _text(v)) for k, v in r.items()] for r in rows],
            [None if f.get("geometry") is None else json.dumps(f["geometry"], separators=(",", ":")) for f in features],
            [partition.path.rsplit("/", 1)[-1]] * len(features),
            [partition.offset + i for i in range(len(features))],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _ARROW, strict=True)], schema=_ARROW)


class PageWriter(DataSourceArrowWriter):
    """One file for each row. A page is written under another name and then moved to its own, so a task that runs twice leaves it whole."""

    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = _open(self.uri)
        system.create_dir(folder)
        for batch in iterator:
            for at, text in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if at is None or at < 0 or text is None:
                    raise ValueError(f"a page needs a text and its place from 0, not {at}")
                own = f"{folder}/page_{at:07d}.geojson"
                draft = f"{folder}/_draft_{at:07d}_{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as stream:
                    stream.write(text.encode())
                system.move(draft, own)
        return WriterCommitMessage()


class FeaturePages(DataSource):
    """Features (properties, geometry, page, at) of a folder of pages; ``at`` is the place in the layer.

    Options: ``path``, an absolute path or a URI that Arrow's filesystems open; ``declared``, the number of features of the layer;
    ``mode``, FAILFAST (a page with an error in it or of another length than declared ends the job) or PERMISSIVE (all that is
    there is read). Values of properties are text, nested ones JSON; nulls stay null. Other files are left out, as is a
    folder without pages, which has no rows but fails if features were declared.

    Writing takes (at, text), both not null: the text of a page and the number of features before it. Pages are added to the folder, those of one ``at`` replaced.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def writer(self, schema, overwrite: bool) -> PageWriter:
        if not {"at", "text"} <= set(schema.fieldNames()):
            raise ValueError("pages are written from columns at and text")
        return PageWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeaturePages)
