"""A stored registry of entities, feature views and services: ``apply`` compares, refuses conflicts and writes a version.

Definitions are rows (kind, name, definition as JSON, schema of the source), so any session can load a service
by its name. A version is a folder; a run that is lost leaves the version before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lodgeworks.operators.store import (
    Entity,
    FeatureService,
    FeatureView,
    PushSource,
    TableSource,
    Transform,
    request_time_features,
)

Definition = Entity | FeatureView | FeatureService
#: Request-time transforms by the name under which a registry stores them.
TRANSFORMS: dict[str, Transform] = {"prices": request_time_features(), "fresh_prices": request_time_features("fresh_")}


class Conflict(ValueError):
    """One name with two definitions."""


def _source(source: TableSource | PushSource | None) -> dict | None:
    if source is None:
        return None
    if isinstance(source, PushSource):
        return {"push": source.name, "batch": _source(source.batch)}
    return {"path": source.path, "timestamp": source.timestamp, "created": source.created}


def _source_of(stored: dict | None) -> TableSource | PushSource | None:
    if stored is None:
        return None
    if "push" in stored:
        return PushSource(stored["push"], _source_of(stored["batch"]))
    return TableSource(stored["path"], stored["timestamp"], stored["created"])


def _described(item: Definition, transforms: dict[str, Transform]) -> tuple[str, dict]:
    if isinstance(item, Entity):
        return "entity", {"keys": list(item.keys)}
    if isinstance(item, FeatureView):
        return "view", {"entity": item.entity.name, "fields": list(item.fields), "ttl_seconds": item.ttl.total_seconds(), "source": _source(item.source)}
    names = {id(t): n for n, t in transforms.items()}
    if unknown := [t for t in item.on_demand if id(t) not in names]:
        raise ValueError(f"service {item.name} uses {len(unknown)} transform(s) that have no name")
    return "service", {
        "views": [[v.name, list(fields)] for v, fields in item.views], "on_demand": [names[id(t)] for t in item.on_demand],
        "log_path": item.log_path, "request_fields": list(item.request_fields)}


def _parts(item: Definition) -> Iterable[Definition]:
    """The definitions that one brings along."""
    if isinstance(item, FeatureService):
        for view, _ in item.views:
            yield from _parts(view)
    if isinstance(item, FeatureView):
        yield item.entity
    yield item


class Registry:
    """Definitions below ``root``; ``transforms`` gives request-time transforms their names."""

    def __init__(self, spark: SparkSession, root: str, transforms: dict[str, Transform] | None = None) -> None:
        self.spark, self.root, self.transforms = spark, root.rstrip("/"), {**TRANSFORMS, **(transforms or {})}

    def version(self) -> int:
        """The newest version; 0 before the first ``apply``."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(at):
            return 0
        complete = [f.getPath().getName() for f in files.listStatus(at) if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return max((int(n.removeprefix("version=")) for n in complete if n.startswith("version=")), default=0)

    def rows(self, version: int | None = None) -> dict[tuple[str, str], tuple[str, str | None]]:
        """(kind, name) to (definition, schema); a row per definition."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return {(r["kind"], r["name"]): (r["definition"], r["schema"]) for r in self.spark.read.parquet(f"{self.root}/version={version}").collect()}

    def _schema(self, item: Definition) -> str | None:
        """The types of a view's fields as its source has them, if it can be read; a field that it lacks raises."""
        if not isinstance(item, FeatureView) or item.table is None:
            return None
        try:
            kinds = dict(item.table.read(self.spark).dtypes)
        except AnalysisException:
            return None
        if absent := [c for c in (*item.entity.keys, item.table.timestamp, *item.fields) if c not in kinds]:
            raise ValueError(f"the source of view {item.name} lacks {absent}")
        return json.dumps({c: kinds[c] for c in (*item.entity.keys, *item.fields)}, sort_keys=True)

    def plan(self, items: Iterable[Definition], remove: Iterable[str] = ()) -> tuple[dict, list[tuple[str, str, str]]]:
        """The rows after ``apply`` and the changes (kind, name, added / changed / removed).

        Raises ``Conflict`` where one name is defined in two ways in ``items``, and ValueError where something
        that is removed is still used.
        """
        stored = self.rows()
        given: dict[tuple[str, str], str] = {}
        schemas: dict[tuple[str, str], str | None] = {}
        conflicts = []
        for item in (p for i in items for p in _parts(i)):
            kind, content = _described(item, self.transforms)
            at, text = (kind, item.name), json.dumps(content, sort_keys=True)
            if given.setdefault(at, text) != text:
                first = json.loads(given[at])
                conflicts.append(f"{kind} {item.name}: " + ", ".join(f"{k} {first[k]!r} or {v!r}" for k, v in content.items() if first[k] != v))
            schemas[at] = self._schema(item)
        if conflicts:
            raise Conflict("; ".join(conflicts))
        gone = set(remove)
        rows = {at: row for at, row in stored.items() if at[1] not in gone}
        rows.update({at: (text, schemas[at]) for at, text in given.items()})
        for (kind, name), (text, _) in rows.items():
            content = json.loads(text)
            used = [("entity", content["entity"])] if kind == "view" else [("view", v) for v, _ in content.get("views", [])]
            if lost := [n for k, n in used if (k, n) not in rows]:
                raise ValueError(f"{kind} {name} needs {lost}")
        changes = [(*at, "removed") for at in stored if at not in rows]
        changes += [(*at, "added" if at not in stored else "changed") for at, row in rows.items() if stored.get(at) != row]
        return rows, sorted(changes)

    def apply(self, items: Iterable[Definition], remove: Iterable[str] = ()) -> DataFrame:
        """Write the next version if anything changes; returns the changes as rows."""
        rows, changes = self.plan(items, remove)
        if changes:
            table = self.spark.createDataFrame([(*at, *row) for at, row in sorted(rows.items())], "kind string, name string, definition string, schema string")
            table.coalesce(1).write.mode("error").parquet(f"{self.root}/version={self.version() + 1}")
        return self.spark.createDataFrame(changes, "kind string, name string, change string")

    def _load(self, kind: str, name: str, version: int | None) -> dict:
        found = self.rows(version).get((kind, name))
        if found is None:
            raise KeyError(f"no {kind} {name}")
        return json.loads(found[0])

    def entity(self, name: str, version: int | None = None) -> Entity:
        return Entity(name, tuple(self._load("entity", name, version)["keys"]))

    def view(self, name: str, version: int | None = None) -> FeatureView:
        stored = self._load("view", name, version)
        return FeatureView(name, self.entity(stored["entity"], version), tuple(stored["fields"]),
                           timedelta(seconds=stored["ttl_seconds"]), _source_of(stored["source"]))

    def service(self, name: str, version: int | None = None) -> FeatureService:
        stored = self._load("service", name, version)
        if unknown := [t for t in stored["on_demand"] if t not in self.transforms]:
            raise ValueError(f"service {name} needs the transforms {unknown}")
        views = tuple((self.view(v, version), tuple(fields)) for v, fields in stored["views"])
        return FeatureService(name, views, tuple(self.transforms[t] for t in stored["on_demand"]), stored["log_path"], tuple(stored["request_fields"]))
