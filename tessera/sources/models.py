"""Model references: a local folder, or an entry of a catalog given by the caller."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class ResolvedModel:
    reference: str
    source: str
    resolved_id: str
    revision: str | None = None
    commit: str | None = None


Catalog = Callable[[str, str | None], tuple[str, str | None]]


def resolve(reference: str, revision: str | None = None, catalog: Catalog | None = None) -> ResolvedModel:
    """An existing folder is local; what looks like a path but isn't there is an error; the rest is
    looked up in the catalog, a function of (reference, revision) to (id, commit)."""
    path = Path(reference).expanduser()
    if path.is_dir():
        return ResolvedModel(reference, "local", str(path.resolve()))
    if path.exists():
        raise ValueError(f"model path must be a folder: {path}")
    if reference[:1] in ("/", ".", "~"):
        raise FileNotFoundError(f"model path not found: {path}")
    if catalog is None:
        raise LookupError(f"no catalog to look up {reference}")
    name, commit = catalog(reference, revision)
    return ResolvedModel(reference, "catalog", name, revision, commit)


def load_options(revision: str | None = None, token: str | None = None, dtype: object = None) -> dict[str, object]:
    """Options of a model loader, those that are set."""
    return {k: v for k, v in (("revision", revision), ("token", token), ("dtype", dtype)) if v is not None}


def matching_device(name: str, classes: list[str] | None) -> bool:
    """Whether a device's name holds one of the classes, case and blanks apart."""
    plain = lambda s: "".join(s.lower().split())
    return classes is None or any(plain(c) in plain(name) for c in classes)


def require_single_device(names: list[str], classes: list[str] | None, stage: str) -> str:
    """The only visible device; the list of names comes from the trainer's own runtime."""
    if len(names) != 1:
        raise RuntimeError(f"{stage} requires exactly one visible device, found {len(names)}")
    if not matching_device(names[0], classes):
        raise RuntimeError(f"unsupported device for {stage}: {names[0]}")
    return names[0]
