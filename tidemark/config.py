"""The public settings, their defaults and their checks."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field

from tidemark.functions.names import valid_table_name


@dataclass(frozen=True)
class Selector:
    """A table (owner and table) or a whole schema (table is None)."""

    owner: str
    table: str | None = None

    @staticmethod
    def parse(text: str) -> list[Selector]:
        """``A.T, B`` as selectors in order; parts after the second are ignored.  An empty list of names is refused."""
        names = [x.strip() for x in text.split(",")]
        if not all(names):
            raise ValueError(f"table.whitelist must name tables or schemas: {text!r}")
        return [Selector(*x.split(".")[:2]) for x in names]


#: Key: (default, kind); a default of ... marks required keys.  Keys and defaults are fixed values, but that the dictionary's
#: key is also known with another word in the middle.
KEYS = {
    "db.name": (..., str), "db.sid": (None, str), "db.hostname": (None, str), "db.port": (None, int), "db.user": (None, str), "db.user.password": (None, str),
    "db.dictionary": ("ONLINE", str), "db.timezone": ("UTC", str), "table.whitelist": (..., str), "tombstones.on.delete": (True, bool), "batch.size": (1000, int),
    "db.fetch.size": (None, int), "start.scn": (0, int), "db.attempts": (3, int), "db.backoff.ms": (10_000, int), "poll.interval.ms": (2000, int),
}

#: What a connection to a database needs; logs and tables in files need none.
CONNECTION = ("db.sid", "db.hostname", "db.port", "db.user", "db.user.password")
#: Settings of the job around, which have no meaning here.
IGNORED = {"name", "connector.class", "tasks.max", "key.converter", "value.converter"}


@dataclass(frozen=True)
class Config:
    values: dict = field(default_factory=dict)

    @staticmethod
    def of(given: dict) -> Config:
        given = {"db.dictionary" if re.fullmatch(r"db\.\w+\.dictionary", k) else k: v for k, v in given.items()}
        if unknown := set(given) - set(KEYS) - IGNORED:
            warnings.warn(f"unknown settings are ignored: {sorted(unknown)}", stacklevel=2)
        values = {}
        for key, (default, kind) in KEYS.items():
            value = given.get(key, default)
            if value is ... or (key == "db.name" and not value):
                raise ValueError(f"{key} must be set")
            if value is not None and kind is bool and not isinstance(value, bool):
                if str(value).lower() not in ("true", "false"):
                    raise ValueError(f"{key} must be true or false")
                value = str(value).lower() == "true"
            values[key] = value if value is None else kind(value)
        if values["db.dictionary"] not in ("ONLINE", "REDO_LOG"):
            raise ValueError("db.dictionary must be ONLINE or REDO_LOG")
        values["db.fetch.size"] = values["db.fetch.size"] or values["batch.size"]
        out = Config(values)
        for s in out.selectors:
            if s.table is not None and not valid_table_name(f"{s.owner}.{s.table}"):
                raise ValueError(f"no valid table name: {s.owner}.{s.table}")
        return out

    @staticmethod
    def read(path: str) -> Config:
        """The settings of a file of ``key=value`` lines."""
        with open(path, encoding="utf-8") as file:
            lines = [x.strip() for x in file if x.strip() and x.strip()[0] not in "#!"]
        return Config.of({k.strip(): v.strip() for k, _, v in (x.partition("=") for x in lines)})

    def for_database(self) -> Config:
        """Itself, if it has what a connection needs."""
        if lacking := [k for k in CONNECTION if self[k] in (None, "")]:
            raise ValueError(f"settings of the connection must be set: {lacking}")
        return self

    def __getitem__(self, key: str):
        return self.values[key]

    @property
    def selectors(self) -> list[Selector]:
        return Selector.parse(self["table.whitelist"])

    @property
    def source_partition(self) -> dict[str, str]:
        return {"db": self["db.name"]}

    @staticmethod
    def describe() -> str:
        """All settings as reStructuredText."""
        lines = []
        for key, (default, kind) in KEYS.items():
            lines += [f"``{key}``", f"  * Type: {kind.__name__}", f"  * Default: {'required' if default is ... else default}", ""]
        return "\n".join(lines)
