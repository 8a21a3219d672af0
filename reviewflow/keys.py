"""Project keys: metadata in a registry folder, keys from the environment only. Nothing here ever writes a key."""

from __future__ import annotations

import base64
import fcntl
import hmac
import json
import os
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path

from reviewflow.operators.identity import IdentityError, Project
from reviewflow.sinks import staged

PREFIX = "REVIEWFLOW_PROJECT_KEY_"
LOCK_SECONDS, POLL_SECONDS = 30.0, 0.05
FIELDS = ("schema_version", "project_id", "project_name", "key_version", "key_fingerprint", "created_at")


def variable(project_id: str) -> str:
    return PREFIX + project_id.upper().replace("-", "_")


def key_from_environment(project_id: str, environ: Mapping[str, str] | None = None) -> bytes:
    raw = (os.environ if environ is None else environ).get(variable(project_id))
    try:
        secret = base64.b64decode(raw or "", validate=True)
    except ValueError as e:
        raise IdentityError("the project's key can't be read") from e
    if len(secret) != 32:
        raise IdentityError("the project's key is missing or has not 32 bytes")
    return secret


@contextmanager
def registry_lock(root: Path, seconds: float = LOCK_SECONDS) -> Iterator[None]:
    """One writer of the registry at a time, across processes."""
    root.mkdir(parents=True, exist_ok=True)
    with (root / ".lock").open("a+") as f:
        end = time.monotonic() + seconds
        while True:
            try:
                fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
                break
            except BlockingIOError:
                if time.monotonic() >= end:
                    raise IdentityError("the registry is locked") from None
                time.sleep(POLL_SECONDS)
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)


def _metadata(path: Path) -> dict:
    m = json.loads(path.read_text(encoding="utf-8"))
    if not isinstance(m, dict) or set(m) != set(FIELDS) or m["project_id"] != path.parent.name:
        raise IdentityError("project metadata are damaged")
    return m


def projects(root: Path) -> list[dict]:
    return [_metadata(p) for p in sorted(Path(root).glob("*/project.json"))]


def register(root: Path, name: str, environ: Mapping[str, str] | None = None, project_id: str | None = None) -> dict:
    """Enter a project whose key is provisioned in the environment; the name must be new."""
    root = Path(root)
    project_id = project_id or str(uuid.uuid4())
    with registry_lock(root):
        if any(p["project_name"] == name for p in projects(root)):
            raise IdentityError("a project of this name exists")
        key = Project(project_id, 1, key_from_environment(project_id, environ))
        m = dict(zip(FIELDS, (1, project_id, name, 1, key.fingerprint, datetime.now(timezone.utc).isoformat()), strict=True))
        with staged(root / project_id / "project.json") as part:
            part.write_text(json.dumps(m, ensure_ascii=False), encoding="utf-8")
    return m


def load(root: Path, name: str | None = None, project_id: str | None = None, environ: Mapping[str, str] | None = None) -> Project:
    """The project of exactly one selector; its key must have the fingerprint on record."""
    if (name is None) == (project_id is None):
        raise IdentityError("give either a name or an id")
    found = [m for m in projects(root) if (m["project_name"] == name if name is not None else m["project_id"] == project_id)]
    if len(found) != 1:
        raise IdentityError("no such project" if not found else "the project's name isn't unique")
    m = found[0]
    project = Project(m["project_id"], m["key_version"], key_from_environment(m["project_id"], environ))
    if not hmac.compare_digest(project.fingerprint, m["key_fingerprint"]):
        raise IdentityError("the key isn't the project's")
    return project
