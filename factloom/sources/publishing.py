"""Publish written directories: all of them or none, and nothing that is not theirs is lost.

New files are first written whole beside their target. A journal beside the first target
says which directories will move where; then each old directory moves aside and the new one
takes its place. What fails on the way is undone at once; what was killed on the way is undone
by ``recover``, which every later publication to the same target runs first. Only when all
new directories are in place does the journal say so, and the old ones go.

Each published directory holds a note (``_published.json``, which readers of Parquet pass over):
the id that all directories of one publication share, where the others are, and what the writer says
of its work.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTE = "_published.json"
#: Files that the driver lists itself.
FEW = 64


class Storage:
    """The few operations on files that Spark has no DataFrame for, by Hadoop's interface."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        at, files = self._at(path)
        return files.makeQualified(at).toString().rstrip("/")

    def exists(self, path: str) -> bool:
        at, files = self._at(path)
        return files.exists(at)

    def is_file(self, path: str) -> bool:
        at, files = self._at(path)
        return files.exists(at) and files.getFileStatus(at).isFile()

    def names(self, path: str) -> list[str]:
        """What lies directly in a directory; nothing in one that is not there."""
        at, files = self._at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []

    def delete(self, path: str) -> None:
        at, files = self._at(path)
        files.delete(at, True)

    def move(self, source: str, target: str) -> None:
        """Rename; a target that is there is an error, as some file systems would move into it."""
        old, files = self._at(source)
        new, _ = self._at(target)
        if files.exists(new):
            raise FileExistsError(f"cannot move {source!r}: {target!r} is there")
        files.mkdirs(new.getParent())
        if not files.rename(old, new):
            raise OSError(f"cannot move {source!r} to {target!r}")

    def data_files(self, paths: Sequence[str], most: int) -> list[tuple[str, int, int]] | None:
        """Path, length and time of the files that Spark would read, or None if there are more than ``most``."""
        found: list[tuple[str, int, int]] = []
        todo = list(paths)
        while todo:
            at, files = self._at(todo.pop())
            for status in files.listStatus(at):
                path = status.getPath()
                if path.getName().startswith((".", "_")):
                    continue
                if status.isDirectory():
                    todo.append(path.toString())
                else:
                    found.append((path.toString(), status.getLen(), status.getModificationTime()))
                if len(found) + len(todo) > most:
                    return None
        return found

    def write_note(self, path: str, note: Mapping[str, Any]) -> None:
        """A new JSON file; one that is there already is an error. ``end`` tells a whole note from a part of one."""
        at, files = self._at(path)
        out = files.create(at, False)
        try:
            out.write(json.dumps({**note, "end": True}).encode())
        finally:
            out.close()

    def read_note(self, path: str) -> dict[str, Any] | None:
        """A note, or None if there is none or its writer was broken off."""
        at, files = self._at(path)
        if not files.exists(at):
            return None
        stream = files.open(at)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            note = json.loads(text)
        except ValueError:
            return None
        return note if isinstance(note, dict) and note.pop("end", False) else None


def beside(target: str, what: str) -> str:
    """A path beside ``target`` for a directory on its way in or out; readers of the parent pass over it."""
    head, slash, tail = target.rstrip("/").rpartition("/")
    return f"{head}{slash}.{tail}__{what}"


def _journal(target: str) -> str:
    return beside(target, "publishing")


def note_of(spark: SparkSession, directory: str) -> dict[str, Any] | None:
    """What the publication of a directory says of itself."""
    return Storage(spark).read_note(f"{directory.rstrip('/')}/{NOTE}")


def publish(spark: SparkSession, staged: Mapping[str, str], about: Mapping[str, Any] | None = None) -> str:
    """Move whole directories, ``staged`` by target, into place together; return the publication's id.

    The first target owns the journal: recover by it.
    """
    files, targets = Storage(spark), list(staged)
    for target in targets:
        recover(spark, target)
    name = uuid.uuid4().hex
    for target, new in staged.items():
        # the files only where there is something to compare them with later
        held = {"files": fingerprint(spark, new, moved=True)} if about else {}
        files.write_note(f"{new}/{NOTE}", {"id": name, "outputs": targets, **held, **(about or {})})
    moves = [{"target": t, "new": n, "old": beside(t, f"old_{name}"), "had": files.exists(t)} for t, n in staged.items()]
    journal = _journal(targets[0])
    files.write_note(f"{journal}/plan.json", {"moves": moves})
    try:
        for move in moves:
            if move["had"]:
                files.move(move["target"], move["old"])
            files.move(move["new"], move["target"])
        files.write_note(f"{journal}/committed.json", {})
    except Exception:
        recover(spark, targets[0])
        raise
    _finish(files, moves, journal)
    return name


def recover(spark: SparkSession, target: str) -> str | None:
    """Bring a broken-off publication to an end: ``"undone"``, ``"finished"``, or None if there is none.

    One that had all its directories in place is finished; of any other, every target
    holds its old files again.
    """
    files, journal = Storage(spark), _journal(target)
    if not files.exists(journal):
        return None
    plan = files.read_note(f"{journal}/plan.json")
    if plan is None:  # nothing was moved before the plan was whole
        files.delete(journal)
        return "undone"
    if files.read_note(f"{journal}/committed.json") is not None:
        _finish(files, plan["moves"], journal)
        return "finished"
    for move in reversed(plan["moves"]):
        moved_in = not files.exists(move["new"]) and files.exists(move["target"])
        if files.exists(move["old"]):
            if moved_in:
                files.move(move["target"], move["new"])
            files.move(move["old"], move["target"])
        elif not move["had"] and moved_in:
            files.move(move["target"], move["new"])
    for move in plan["moves"]:
        files.delete(move["new"])
    files.delete(journal)
    return "undone"


def _finish(files: Storage, moves: Sequence[Mapping[str, Any]], journal: str) -> None:
    for move in moves:
        files.delete(move["old"])
    files.delete(journal)


def require_one_publication(spark: SparkSession, *directories: str) -> str:
    """The id that directories were published under; raise if they are not of one publication."""
    ids = [(note_of(spark, d) or {}).get("id") for d in directories]
    if None in ids or len(set(ids)) > 1:
        raise ValueError(f"{', '.join(directories)} are not of one publication: {ids}")
    return ids[0]


def listed(spark: SparkSession, *paths: str) -> DataFrame:
    """path, length and modificationTime of the data files under paths; no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, *paths: str, moved: bool = False) -> str:
    """A digest of the data files under paths: their paths, lengths and times, in no order.

    With ``moved`` only names and lengths count, which a file keeps wherever it goes. More than
    ``FEW`` files are summed up in tasks.
    """
    if (few := Storage(spark).data_files(paths, FEW)) is not None:
        of = sorted((p.rsplit("/", 1)[-1], n) if moved else (p, n, t) for p, n, t in few)
        return f"{len(of)}:{sum(n for _, n, _ in few)}:{hashlib.sha256(repr(of).encode()).hexdigest()}"
    name = F.substring_index("path", "/", -1)
    of = [name, F.col("length")] if moved else [F.col("path"), F.col("length"), F.col("modificationTime")]
    row = listed(spark, *paths).agg(
        F.count("*").alias("n"), F.sum("length").alias("bytes"),
        *[F.sum(F.xxhash64(F.lit(seed), *of).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]).first()
    return f"{row['n']}:{row['bytes'] or 0}:{row['h1'] or 0}:{row['h2'] or 0}"
