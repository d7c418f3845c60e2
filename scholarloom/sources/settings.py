"""Settings from the environment, a .env file and the Spark session; missing keys are errors where they are needed."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import SparkSession


class ConfigError(RuntimeError):
    """A setting that is needed is missing."""


#: The variables' names. Fixed values.
VARIABLES = {
    "publisher_key": "ELSEVIER_API_KEY", "open_access_key": "SPRINGER_OA_API_KEY", "metadata_key": "SPRINGER_META_API_KEY",
    "parser_executable": "MINERU_EXECUTABLE", "parser_tier": "MINERU_TIER",
}


@dataclass(frozen=True)
class Settings:
    publisher_key: str | None = None
    open_access_key: str | None = None
    metadata_key: str | None = None
    parser_executable: str | None = None
    parser_tier: str = "advanced"
    http_timeout: float = 60.0

    def require(self, name: str) -> str:
        value = getattr(self, name)
        if not value:
            raise ConfigError(f"{VARIABLES[name]} is not configured.")
        return value

    def keys(self) -> dict[str, str]:
        """The access keys that are there, by the names that requests use."""
        return {n.removesuffix("_key"): getattr(self, n) for n in ("publisher_key", "open_access_key", "metadata_key") if getattr(self, n)}

    def __repr__(self) -> str:
        shown = (f"{f.name}={'***' if f.name.endswith('_key') and getattr(self, f.name) else repr(getattr(self, f.name))}" for f in fields(self))
        return f"Settings({', '.join(shown)})"


def dotenv(path: str | Path) -> dict[str, str]:
    """NAME=value lines; blank lines, comments and quotes around values are dropped."""
    out = {}
    p = Path(path)
    for line in p.read_text("utf-8").splitlines() if p.is_file() else []:
        name, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and name and not name.startswith("#"):
            out[name.strip()] = value.strip().strip("\"'")
    return out


def load_settings(spark: SparkSession | None = None, *, env: Mapping[str, str] | None = None, file: str | Path = ".env") -> Settings:
    """The session's scholarloom.<name> comes first, then the environment, then the file."""
    found = dotenv(file) | dict(os.environ if env is None else env)
    out = {}
    for name, variable in VARIABLES.items():
        value = (spark.conf.get(f"scholarloom.{name}", None) if spark else None) or found.get(variable)
        if value:
            out[name] = value
    return Settings(**out)
