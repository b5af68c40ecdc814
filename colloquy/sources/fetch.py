"""Contracts of what reaches outside: fetching feeds and unpacking archives."""

from __future__ import annotations

import tarfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HREF = pa.struct([("href", pa.string())])
LINK = pa.struct([("rel", pa.string()), ("href", pa.string())])
MEDIA = pa.struct([("url", pa.string()), ("href", pa.string())])
ENTRY = pa.struct([("title", pa.string()), ("enclosures", pa.list_(HREF)), ("links", pa.list_(LINK)), ("media_content", pa.list_(MEDIA))])
DDL = "url string, entries array<struct<title string, enclosures array<struct<href string>>, links array<struct<rel string, href string>>, media_content array<struct<url string, href string>>>>, error string"


def fetch_entries(urls: DataFrame, url: str, load: Callable[[], Callable[[str], list[dict]]]) -> DataFrame:
    """``url``, ``entries``, ``error`` of each distinct feed. ``load`` makes a fetcher once per Python worker; what it raises
    is a row, not a failed job. Entries have the shape that entry_audio() takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = None
        for b in batches:
            entries, errors = [], []
            for u in b.column("url").to_pylist():
                try:
                    fetch = fetch or load()
                    entries.append(fetch(u))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    entries.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.record_batch([b.column("url"), pa.array(entries, pa.list_(ENTRY)), pa.array(errors, pa.string())], ["url", "entries", "error"])

    return urls.select(F.col(url).alias("url")).where("url is not null").distinct().mapInArrow(run, DDL)


def cached(url: str, folder: str, load: Callable[[str], bytes]) -> str:
    """The file of a url below ``folder``, named by its last part; ``load`` is asked only where there is none yet, or an empty
    one. It gets its name when it is whole. Raises ValueError for an empty answer."""
    target = Path(folder) / (url.split("?")[0].split("#")[0].rstrip("/").rpartition("/")[2] or "download")
    if target.is_file() and target.stat().st_size:
        return str(target)
    content = load(url)
    if not content:
        raise ValueError(f"{url}: empty")
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    part.write_bytes(content)
    part.replace(target)
    return str(target)


def unpack_database(archive: str, folder: str) -> str:
    """The first ``*.db`` member of a tar archive, unpacked below ``folder``. Raises ValueError for a name that leads out of
    it, or if there is none."""
    root = Path(folder).resolve()
    with tarfile.open(archive) as tar:
        for member in tar:
            if member.isfile() and member.name.endswith(".db"):
                target = (root / member.name).resolve()
                if not target.is_relative_to(root):
                    raise ValueError(f"unsafe name {member.name!r}")
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_bytes(tar.extractfile(member).read())
                return str(target)
    raise ValueError(f"{archive} has no database")
