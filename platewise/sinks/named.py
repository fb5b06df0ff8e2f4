"""Text files whose names come from the rows.

Spark's own writers name their files themselves. Here a task writes each file under a
pending name of its attempt; when the job commits, the pending files of the attempts that
count are moved to their names, and all others are deleted. So no name ever holds half a
file, and a failed or repeated task leaves none.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from platewise.columns import columns

FILE, LINE = "__file", "__line"
PENDING = "_pending"
# Moves that the commit has under way at a time.
MOVES = 32


@dataclass
class Finished(WriterCommitMessage):
    """What one attempt of a task wrote: the pending name of each file."""

    pending: dict[str, str] = field(default_factory=dict)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    found, folder = fs.FileSystem.from_uri(path)
    return found, folder.rstrip("/")


def _checked(name: str | None) -> str:
    """A name that stays inside the folder."""
    parts = (name or "").split("/")
    if not name or name.startswith("/") or any(p in ("", ".", "..", PENDING) for p in parts):
        raise ValueError(f"no name for a file: {name!r}")
    return name


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.header = options["path"], options.get("header")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Finished:
        store, folder = _place(self.path)
        attempt = uuid.uuid4().hex
        done, name, stream = Finished(), None, None
        try:
            for batch in batches:
                files, lines = batch.column(FILE), batch.column(LINE)
                # Rows of a file come together, so a run ends where the name changes.
                runs = pc.run_end_encode(files) if len(files) else None
                begin = 0
                for value, end in zip(runs.values, runs.run_ends) if runs else ():
                    found = _checked(value.as_py())
                    if found != name:
                        if stream:
                            stream.close()
                        if found in done.pending:
                            raise ValueError(f"rows of {found} do not come together")
                        name = found
                        done.pending[name] = f"{folder}/{PENDING}/{attempt}-{len(done.pending)}"
                        store.create_dir(f"{folder}/{PENDING}", recursive=True)
                        stream = store.open_output_stream(done.pending[name], compression=None)
                        if self.header is not None:
                            stream.write(f"{self.header}\n".encode())
                    end = end.as_py()
                    run = pc.fill_null(lines.slice(begin, end - begin), "")
                    stream.write(("\n".join(run.to_pylist()) + "\n").encode())
                    begin = end
            if stream:
                stream.close()
            return done
        except BaseException:
            if stream and not stream.closed:
                stream.close()
            _delete(store, done.pending.values())
            raise

    def commit(self, messages: list[Finished | None]) -> None:
        store, folder = _place(self.path)
        store.create_dir(folder, recursive=True)
        moves: dict[str, str] = {}
        for message in messages:
            for name, pending in message.pending.items() if message else ():
                if name in moves:
                    raise ValueError(f"two tasks wrote {name}")
                moves[name] = pending
        for parent in {posixpath.dirname(f"{folder}/{name}") for name in moves}:
            store.create_dir(parent, recursive=True)

        def move(item: tuple[str, str]) -> None:
            target = f"{folder}/{item[0]}"
            if store.get_file_info(target).type != fs.FileType.NotFound:
                store.delete_file(target)
            store.move(item[1], target)

        with ThreadPoolExecutor(MOVES) as threads:
            list(threads.map(move, moves.items()))
        # What attempts that do not count have left.
        if store.get_file_info(f"{folder}/{PENDING}").type != fs.FileType.NotFound:
            store.delete_dir(f"{folder}/{PENDING}")

    def abort(self, messages: list[Finished | None]) -> None:
        store, _ = _place(self.path)
        _delete(store, [p for m in messages if m for p in m.pending.values()])


def _delete(store: fs.FileSystem, paths: Sequence[str]) -> None:
    for path in paths:
        if store.get_file_info(path).type != fs.FileType.NotFound:
            store.delete_file(path)


class NamedFiles(DataSource):
    """``df.write`` of the format ``named_files``: columns ``__file`` and ``__line``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(dict(self.options))


def csv_header(names: Sequence[str]) -> str:
    """The names as a line of CSV, quoted only where needed."""
    quoted = ['"' + n.replace('"', '""') + '"' if set(n) & set(',"\r\n') else n for n in names]
    return ",".join(quoted)


def csv_line(names: Sequence[str]) -> Column:
    """The columns as a line of CSV, quoted where needed, quotes doubled, null as nothing."""
    options = {
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    # Spark writes no line for a row of nulls alone, so a last cell is put in and cut off.
    line = F.to_csv(F.struct(*columns(names), F.lit("x")), options)
    return F.left(line, F.length(line) - 2)


def write_named_files(
    df: DataFrame,
    path: str,
    file: Column,
    line: Column,
    order: Sequence[Column] = (),
    *,
    header: str | None = None,
    deal: bool = True,
) -> str:
    """Write ``line`` of every row to the text file that ``file`` names, below ``path``.

    A file is one task's, which streams its lines in ``order``, one file after the other.
    Files are dealt over the tasks by name unless ``deal`` says that the rows of each are
    together already. Files of these names are replaced, others stay. Rows without a name
    raise, a null line is an empty one, and no rows write no file.
    """
    df.sparkSession.dataSource.register(NamedFiles)
    named = df.withColumns({FILE: file, LINE: line})
    # As many tasks as shuffles have; adaptive execution joins the small ones.
    dealt = named.repartition(F.col(FILE)) if deal else named
    rows = dealt.sortWithinPartitions(F.col(FILE), *order).select(FILE, LINE)
    options = {"header": header} if header is not None else {}
    rows.write.format("named_files").mode("append").options(**options).save(path)
    return path
