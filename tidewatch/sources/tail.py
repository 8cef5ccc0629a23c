"""Growing log files as a stream (ST1, S9) with a count-or-time flush (ST5).

``tailed_files`` is a Python streaming data source.  Its offset holds, for each file, the end of the last
complete line and an identity (length and hash of its first line), so

* appended lines are read once: a restart continues at the byte offsets of the query's checkpoint;
* a partial last line is held back until its line feed is written;
* rotation is seen by identity: a file whose name now starts with another first line, or that is shorter
  than what was read, was replaced.  The rest of the old one is read where it was moved to (a name
  beside it), then the new one from its start.

What a batch covers is a function of its start and end offsets alone, so a replayed batch is the same.
A batch is let go when ``minLines`` lines are waiting or the first of them has waited ``maxDelaySeconds``;
what waits when a query starts is let go at once, and a partial buffer never waits for ever.

Lines are dealt to tasks by byte ranges.  Paths may be local or of any store that ``pyarrow.fs`` opens; all
executors must see them.  Compressed names (``.gz`` and the like) aren't followed.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
import re
import time
from collections.abc import Iterator

from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

HEAD = 4096  # bytes of a first line that count for a file's identity
BLOCK = 1 << 20
PACKED = (".gz", ".zst", ".bz2", ".xz", ".lz4")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _first_line(f, size: int) -> list | None:
    """[length, hash] of the first line, None while it isn't whole."""
    head = f.read_at(min(HEAD, size), 0)
    cut = head.find(b"\n") + 1
    if not cut and size < HEAD:
        return None
    head = head[:cut or HEAD]
    return [len(head), hashlib.sha256(head).hexdigest()[:16]]


def _last_line_end(f, size: int) -> int:
    end = size
    while end > 0:
        start = max(0, end - BLOCK)
        at = f.read_at(end - start, start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        end = start
    return 0


class Range(InputPartition):
    def __init__(self, name: str, start: int, end: int, stop: int, identity: list):
        self.name, self.start, self.end, self.stop, self.identity = name, start, end, stop, identity


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.fs, path = _store(options["path"])
        self.only = None
        info = self.fs.get_file_info(path.rstrip("/"))
        if info.type == pafs.FileType.Directory:
            self.folder, self.pattern = path.rstrip("/"), "*"
        else:
            self.folder, name = posixpath.split(path)
            self.pattern = name
            if not re.search(r"[*?\[]", name):  # one file: its neighbours matter only as what it was moved to
                self.only, self.pattern = path, name + "*"
        self.latest = str(options.get("startingOffsets", "latest")) == "latest"
        self.min_lines = int(options.get("minLines", 10))
        self.max_delay = float(options.get("maxDelaySeconds", 5.0))
        self.counted = re.compile(options["countPattern"].encode()) if options.get("countPattern") else None
        self.split = int(options.get("bytesPerPartition", 64 << 20))
        self.seen: dict[str, tuple[int, list]] = {}  # size when last looked at, and what was found
        self.given: dict | None = None  # the offset last given out
        self.released = False
        self.waiting_since: float | None = None

    def files(self) -> dict[str, list]:
        """name: [end of the last line, length and hash of the first line] of the files that hold a line."""
        out = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True)):
            name = info.base_name
            if info.type != pafs.FileType.File or not info.size or name[0] in "._" or name.endswith(PACKED) or not fnmatch.fnmatch(name, self.pattern):
                continue
            try:
                with self.fs.open_input_file(info.path) as f:
                    first = _first_line(f, info.size)
                    if first is None:
                        continue
                    known = self.seen.get(info.path)
                    if known and known[0] == info.size and known[1][1:] == first:
                        out[info.path] = known[1]
                        continue
                    end = _last_line_end(f, info.size)
            except FileNotFoundError:  # moved while we looked
                continue
            out[info.path] = [end, *first]
            self.seen[info.path] = (info.size, out[info.path])
        return out

    def initialOffset(self) -> dict:
        self.given = {"files": self.files() if self.latest else {}}
        return self.given

    def ranges(self, start: dict, end: dict) -> list[tuple[str, int, int, list]]:
        """(name, from, to, identity) of what lies between two offsets."""
        old, new = start["files"], end["files"]
        stayed = {n for n, (e, *first) in new.items() if n in old and old[n][1:] == first and old[n][0] <= e}
        gone = [n for n in old if n not in stayed]
        out = []
        for name, (e, *first) in sorted(new.items()):
            if name in stayed:
                s = old[name][0]
            else:
                was = next((n for n in gone if old[n][1:] == first and old[n][0] <= e), None)
                if was is not None:
                    gone.remove(was)
                    s = old[was][0]
                elif self.only in (None, name):
                    s = 0
                else:
                    continue
            if s < e:
                out.append((name, s, e, first))
        return out

    def lines_waiting(self, todo: list[tuple[str, int, int, list]]) -> bool:
        """Whether ``min_lines`` lines wait; a megabyte counts as enough without a look."""
        if sum(e - s for _, s, e, _ in todo) >= BLOCK:
            return True
        n = 0
        for name, s, e, _ in todo:
            with self.fs.open_input_file(name) as f:
                lines = f.read_at(e - s, s).split(b"\n")
            n += sum(1 for x in lines if x.strip() and (not self.counted or self.counted.search(x)))
        return n >= self.min_lines

    def latestOffset(self) -> dict:
        now = {"files": self.files()}
        if self.given is not None and self.released:
            todo = self.ranges(self.given, now)
            if not todo:
                self.waiting_since = None
                return self.given
            if self.waiting_since is None:
                self.waiting_since = time.monotonic()
            if time.monotonic() - self.waiting_since < self.max_delay and not self.lines_waiting(todo):
                return self.given
        self.given, self.released, self.waiting_since = now, True, None
        return now

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return [Range(n, a, min(a + self.split, e), e, first) for n, s, e, first in self.ranges(start, end) for a in range(s, e, self.split)]

    def read(self, partition: Range) -> Iterator[tuple]:
        """(line, file, start of the range, offset of the line) of the lines that begin inside the range."""
        p = partition
        with self._opened(p) as f:
            at, rest = p.start, b""
            if at and f.read_at(1, at - 1) != b"\n":  # the line before ends in this range
                while at < p.stop:
                    block = f.read_at(min(BLOCK, p.stop - at), at)
                    cut = block.find(b"\n") + 1
                    at += cut or len(block)
                    if cut:
                        break
            begin = at
            while begin < p.end and at < p.stop:
                block = f.read_at(min(BLOCK, p.stop - at), at)
                at += len(block)
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    if begin < p.end:
                        yield (line, p.name, p.start, begin)
                    begin += len(line) + 1

    def _opened(self, p: Range):
        """The file of a range, also if it has been moved since the batch was planned."""
        names = [p.name, *(i.path for i in self.fs.get_file_info(pafs.FileSelector(self.folder)) if i.type == pafs.FileType.File and i.path != p.name)]
        for name in names:
            try:
                f = self.fs.open_input_file(name)
            except FileNotFoundError:
                continue
            if f.size() >= p.stop and _first_line(f, f.size()) == p.identity:
                return f
            f.close()
        raise FileNotFoundError(f"{p.name}, bytes {p.start} to {p.stop}: replaced, and not found beside its place")

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class TailedFiles(DataSource):
    """Format ``tailed_files``: (value binary, file, block, pos); options ``path``, ``startingOffsets`` (``latest``:
    skip what is there; ``earliest``), ``minLines``, ``maxDelaySeconds``, ``countPattern`` (which lines count),
    ``bytesPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return "tailed_files"

    def schema(self) -> str:
        return "value binary, file string, block long, pos long"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)
