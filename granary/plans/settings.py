"""Run settings, the Spark session, retries and log redaction."""

from __future__ import annotations

import json
import logging
import os
import random
import re
import time
from collections.abc import Callable, Mapping
from dataclasses import MISSING, dataclass, field, fields
from pathlib import Path

from pyspark.sql import SparkSession

from granary.operators.features import FeatureConfig
from granary.sources.csv import Format
from granary.sources.publish import WriteOptions

log = logging.getLogger("granary")

# fixed values: parts of names whose values never reach a log, what stands for them, and messages of passing faults
SECRET_NAMES = ("access_key", "authorization", "cookie", "credential", "database_url", "password", "private_key", "secret", "session_token", "token")
REDACTED = "[REDACTED]"
PASSING = (
    "connection reset", "connection timed out", "connection timeout", "request timeout", "service unavailable", "slow down", "temporarily unavailable",
    "throttl",
)
#: More of both: other spellings of the same.
MORE_SECRET_NAMES = ("passwd", "api_key", "apikey")
MORE_PASSING = ("slowdown", "connection refused")


@dataclass(frozen=True)
class Retry:
    attempts: int = 5
    first_s: float = 0.5
    most_s: float = 30.0
    factor: float = 2.0
    jitter_s: float = 1.0

    def __post_init__(self):
        if self.attempts < 1 or self.first_s < 0 or self.most_s < self.first_s or self.factor < 1 or self.jitter_s < 0:
            raise ValueError(f"bad retry settings: {self}")

    def call[T](self, action: Callable[[], T], sleep: Callable[[float], None] = time.sleep) -> T:
        """``action``'s result; passing faults are tried again with growing pauses."""
        for k in range(self.attempts):
            try:
                return action()
            except Exception as e:
                if k + 1 == self.attempts or not passing(e):
                    raise
                sleep(min(self.first_s * self.factor**k, self.most_s) + random.uniform(0, self.jitter_s))
        raise AssertionError


def passing(e: BaseException) -> bool:
    return isinstance(e, OSError) or any(m in str(e).casefold() for m in PASSING + MORE_PASSING)


@dataclass(frozen=True)
class SparkOptions:
    """What a session of these settings is made with; an empty master leaves it to the environment."""

    master: str = ""
    log_level: str = "WARN"
    shuffle_partitions: int = 200

    def __post_init__(self):
        if self.log_level not in ("ALL", "DEBUG", "ERROR", "FATAL", "INFO", "OFF", "TRACE", "WARN"):
            raise ValueError(f"unknown log level: {self.log_level}")
        if self.shuffle_partitions < 1:
            raise ValueError("shuffle_partitions must be at least 1")


@dataclass(frozen=True)
class Settings:
    raw_root: str
    curated_root: str
    checkpoint_root: str
    source_root: str = ""
    environment: str = "development"
    fail_fast: bool = True
    store_partitions: int | None = None
    retry: Retry = field(default_factory=Retry)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    write: WriteOptions = field(default_factory=WriteOptions)
    csv: Format = field(default_factory=Format)
    spark: SparkOptions = field(default_factory=SparkOptions)

    def __post_init__(self):
        if self.environment not in ("development", "test", "staging", "production"):
            raise ValueError(f"unknown environment: {self.environment}")
        apart({"source": self.source_root, "raw": self.raw_root, "curated": self.curated_root, "checkpoints": self.checkpoint_root})


def apart(layers: Mapping[str, str]) -> None:
    """No layer may lie in another."""
    named = [(n, p.removeprefix("file://").rstrip("/") + "/") for n, p in layers.items() if p]
    for k, (a, p) in enumerate(named):
        for b, q in named[k + 1 :]:
            if p.startswith(q) or q.startswith(p):
                raise ValueError(f"the {a} and {b} layers overlap: {p} and {q}")


def _value(text: str, like):
    """Text as a value of the kind of a setting's default."""
    if isinstance(like, bool):
        if text.lower() not in ("1", "true", "yes", "0", "false", "no"):
            raise ValueError(f"not a truth value: {text!r}")
        return text.lower() in ("1", "true", "yes")
    if isinstance(like, tuple):
        return tuple(_value(x.strip(), like[0]) for x in text.split(",") if x.strip())
    if like is None:
        return int(text) if text else None
    return type(like)(text)


def _read(kind: type, env: Mapping[str, str], prefix: str) -> dict:
    """A dataclass's plain fields that are set as PREFIX_FIELD."""
    out = {}
    for f in fields(kind):
        like = f.default if f.default is not MISSING else ""
        if f.default_factory is MISSING and (name := prefix + f.name.upper()) in env:
            try:
                out[f.name] = _value(env[name], like)
            except ValueError as e:
                raise ValueError(f"{name}: {e}") from e
    return out


def env_file(path: str) -> dict[str, str]:
    """NAME=value lines of a file; blank lines and those after # are skipped, quotes around a value removed."""
    out = {}
    for number, line in enumerate(Path(path).read_text(encoding="utf-8").splitlines(), 1):
        line = line.strip().removeprefix("export ")
        if line and not line.startswith("#"):
            name, is_set, value = line.partition("=")
            if not is_set or not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name.strip()):
                raise ValueError(f"{path}, line {number}: not NAME=value")
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def located(path: str, root: str) -> str:
    """A local path, relative ones below ``root``; URIs and empty paths as they are."""
    return path if not path or "://" in path or path.startswith("/") else str(Path(root) / path)


def from_env(env: Mapping[str, str] = os.environ, prefix: str = "GRANARY_", file: str | None = None, root: str | None = None, **given) -> Settings:
    """Settings from PREFIX_NAME variables, overridden by what is given.

    Retries, features, writes, files and sessions are PREFIX_RETRY_NAME, _FEATURES_, _WRITE_, _CSV_ and _SPARK_NAME; lists are comma-separated.
    Variables of the process override those of ``file``; relative folders lie below ``root``, if there is one.
    """
    env = (env_file(file) if file else {}) | dict(env)
    groups = {"retry": Retry, "features": FeatureConfig, "write": WriteOptions, "csv": Format, "spark": SparkOptions}
    read = _read(Settings, env, prefix) | {n: kind(**found) for n, kind in groups.items() if (found := _read(kind, env, f"{prefix}{n.upper()}_"))}
    read |= given
    if root:
        read |= {n: located(p, root) for n, p in read.items() if n.endswith("_root")}
    return Settings(**read)


def session(settings: Settings, name: str = "granary") -> SparkSession:
    """A session with the library's knobs; any other session serves as well."""
    builder = SparkSession.builder.appName(name)
    if master := settings.spark.master or ("local[*]" if settings.environment in ("development", "test") else ""):
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.caseSensitive": "true",
        "spark.sql.shuffle.partitions": str(settings.spark.shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    made = builder.config(map=conf).getOrCreate()
    made.sparkContext.setLogLevel(settings.spark.log_level)
    return made


def redacted(value):
    """``value`` without what its keys name as secret, at any depth."""
    if isinstance(value, Mapping):
        secret = lambda k: any(s in re.sub(r"[- ]", "_", str(k).casefold()) for s in SECRET_NAMES + MORE_SECRET_NAMES)
        return {k: REDACTED if secret(k) else redacted(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [redacted(v) for v in value]
    return value


class JsonLines(logging.Formatter):
    """One JSON object a record; extra fields go under ``fields``, redacted."""

    def format(self, record: logging.LogRecord) -> str:
        line = {"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if extra := getattr(record, "fields", None):
            line["fields"] = redacted(extra)
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str)
