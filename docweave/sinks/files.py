"""Small files and folders written so that a reader never sees half of one: state, reports, document bundles."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_json(value: Any) -> str:
    """UTF-8 text, indented by two, with a newline at the end; the same for the same value."""
    return json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False) + "\n"


def file_record(path: Path, root: Path | None = None) -> dict:
    data = Path(path).read_bytes()
    return {"path": str(Path(path).relative_to(root)) if root else Path(path).name, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}


def write_atomic(path: Path, text: str) -> None:
    """Write beside the file, sync, then replace it; on a failure the old file stays."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    try:
        with open(beside, "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(beside, path)
    finally:
        beside.unlink(missing_ok=True)


def publish(staged: Path, target: Path) -> None:
    """Put a finished folder in the place of ``target``; the previous one comes back if that fails."""
    staged, target = Path(staged), Path(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    old = target.with_name(f".{target.name}.{uuid.uuid4().hex}.old")
    had = target.exists()
    if had:
        os.replace(target, old)
    try:
        os.replace(staged, target)
    except OSError:
        if had:
            os.replace(old, target)
        raise
    if had:
        shutil.rmtree(old)


def tree_lines(nodes: list[dict]) -> str:
    """Nodes with ``depth`` and ``type`` (and a label, if any), one a line, indented by depth."""
    return "\n".join("  " * n["depth"] + n["type"] + (f" {n['label']}" if n.get("label") else "") for n in nodes)


def markdown_table(rows: list[dict]) -> str:
    if not rows:
        return "_none_\n"
    names = list(rows[0])
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *["| " + " | ".join(cell(r.get(n)) for n in names) + " |" for r in rows]]) + "\n"


def write_report(folder: Path, title: str, sections: dict[str, list[dict]]) -> None:
    """report.json and report.md of small tables."""
    write_atomic(Path(folder) / "report.json", canonical_json(sections))
    write_atomic(Path(folder) / "report.md", f"# {title}\n" + "".join(f"\n## {k}\n\n{markdown_table(v)}" for k, v in sections.items()))


class Progress:
    """State of a run in one JSON file: its settings, captured ids in order, attempts.

    Settings that differ from those of an earlier run are an error, so a run goes on or starts anew, never both.
    """

    def __init__(self, path: Path, settings: dict):
        self.path, self.state = Path(path), {"settings": settings, "captured": [], "attempts": []}
        if self.path.exists():
            old = json.loads(self.path.read_text(encoding="utf-8"))
            wrong = sorted(k for k in settings.keys() | old["settings"].keys() if old["settings"].get(k) != settings.get(k))
            if wrong:
                raise ValueError(f"settings differ from the run's: {', '.join(wrong)}")
            self.state = old

    def add(self, attempt: dict) -> None:
        """Record an attempt; saved before the next step begins."""
        self.state["attempts"].append(attempt)
        if attempt.get("result") in ("complete", "reused_capture", "existing_capture") and attempt["document_id"] not in self.state["captured"]:
            self.state["captured"].append(attempt["document_id"])
        write_atomic(self.path, canonical_json(self.state))

    def pending(self, target: list[str]) -> list[str]:
        done = set(target)
        return [x for x in self.state["captured"] if x not in done]

    def text(self) -> str:
        s = self.state
        return f"{len(s['captured'])} captured in {len(s['attempts'])} attempts, target {s['settings'].get('target', 'not set')}"


def write_bundles(rows: DataFrame, folder: str, key: str, name: str, body: str) -> DataFrame:
    """One folder for each document, by one task each: files, manifest with hashes, read again, published.

    ``rows`` has the document's key, a file name and its text.  A document
    whose files repeat a name, or read back otherwise than written, is not
    published and keeps its previous folder.  Returns (key, files, published,
    problem).  The folder is one that executors share.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for doc, files in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                problem = _bundle(Path(folder), str(doc), [(f["name"], f["body"]) for f in files])
                out.append((doc, len(files), problem is None, problem))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.string())], names=["key", "files", "published", "problem"])

    # a document's files meet in one row, as its folder is published at once
    grouped = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.sort_array(F.collect_list(F.struct(F.col(name).alias("name"), F.col(body).alias("body")))).alias("files"))
    return grouped.mapInArrow(run, f"key {rows.schema[key].dataType.simpleString()}, files int, published boolean, problem string")


def _bundle(folder: Path, doc: str, files: list[tuple[str, str]]) -> str | None:
    names = [n for n, _ in files]
    if len(set(names)) < len(names):
        return "repeated_file_names"
    if doc in ("", ".", "..") or "/" in doc or any(not n or "/" in n or n in (".", "..", "manifest.json") for n in names):
        return "unsafe_name"
    staged = folder / f".staging-{uuid.uuid4().hex}"
    try:
        staged.mkdir(parents=True)
        for n, text in files:
            write_atomic(staged / n, text or "")
        records = [file_record(staged / n) for n in names]
        write_atomic(staged / "manifest.json", canonical_json({"document_id": doc, "files": records}))
        again = json.loads((staged / "manifest.json").read_text(encoding="utf-8"))["files"]
        written = [{"path": n, "bytes": len((t or "").encode()), "sha256": hashlib.sha256((t or "").encode()).hexdigest()} for n, t in files]
        if again != written or [file_record(staged / n) for n in names] != written:
            return "checksum_differs"
        publish(staged, folder / doc)
        return None
    finally:
        shutil.rmtree(staged, ignore_errors=True)


def fingerprint(paths: list[Path]) -> str:
    """One hash over the contents of files in the order of their names."""
    h = hashlib.sha256()
    for p in sorted(map(Path, paths), key=str):
        h.update(f"{p.name}\0{hashlib.sha256(p.read_bytes()).hexdigest()}\n".encode())
    return h.hexdigest()
