"""The landing zone: raw files by source and ingest date, with a manifest of digests, and declared-schema scans."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extracts, their sources and their schemas. Codes stay strings.
EXTRACTS = {
    "ehr_sessions.csv": ("ehr", "session_id string, client_id string, provider_id string, service_code string, service_date date, center_id string, duration_value string, duration_uom string, status string, source_system string"),
    "payer_authorizations.csv": ("payer_api", "auth_id string, client_id string, payer_id string, service_code string, units_authorized double, period_start date, period_end date, issued_date date"),
    "salesforce_clients.csv": ("salesforce", "client_id string, effective_date date, age_years int, home_center_id string, payer_id string, change_reason string"),
    "reference_providers.csv": ("reference", "provider_id string, role string, discipline string, center_id string, hire_date date, term_date date"),
    "reference_centers.csv": ("reference", "center_id string, center_name string, state string"),
    "reference_payers.csv": ("reference", "payer_id string, payer_name string, contract_type string"),
}


class Backend(Protocol):
    name: str

    def put(self, key: str, body: bytes) -> None: ...
    def get(self, key: str) -> bytes: ...
    def exists(self, key: str) -> bool: ...
    def uri(self, key: str) -> str: ...


class LocalBackend:
    name = "local"

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def put(self, key: str, body: bytes) -> None:
        path = self.root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(path.name + ".part")
        part.write_bytes(body)
        os.replace(part, path)

    def get(self, key: str) -> bytes:
        return (self.root / key).read_bytes()

    def exists(self, key: str) -> bool:
        return (self.root / key).exists()

    def uri(self, key: str) -> str:
        return str(self.root / key)


class HadoopBackend:
    """Any store that Hadoop has a file system for, such as s3a://."""

    name = "hadoop"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, key: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}")

    def put(self, key: str, body: bytes) -> None:
        out = self.fs.create(self._path(key), True)
        try:
            out.write(bytearray(body))
        finally:
            out.close()

    def get(self, key: str) -> bytes:
        return bytes(self.spark.read.format("binaryFile").load(self.uri(key)).select("content").first()[0])

    def exists(self, key: str) -> bool:
        return self.fs.exists(self._path(key))

    def uri(self, key: str) -> str:
        return f"{self.root}/{key}"


class CredentialError(RuntimeError):
    """Credentials that are there but incomplete or rejected: an operator's error, never a reason to fall back."""


def choose_backend(spark: SparkSession, remote: str | None, local: str | Path, env: dict[str, str] | None = None) -> Backend:
    """The remote store if one is named and reachable; the local one if there are no credentials or no network."""
    env = dict(os.environ) if env is None else env
    if not remote:
        return LocalBackend(local)
    given = [bool(env.get(k)) for k in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")]
    if remote.startswith("s3") and not any(given):
        return LocalBackend(local)
    if remote.startswith("s3") and not all(given):
        raise CredentialError("one of the two access keys is missing")
    try:
        backend = HadoopBackend(spark, remote)
        backend.exists("")
        return backend
    except Exception as e:
        if any(w in str(e) for w in ("403", "AccessDenied", "InvalidAccessKeyId", "SignatureDoesNotMatch")):
            raise CredentialError("the store rejected the credentials") from e
        return LocalBackend(local)


def key_of(source: str, ingest_date: str, filename: str) -> str:
    return f"raw/source={source}/ingest_date={ingest_date}/{filename}"


def source_of(filename: str) -> str:
    if filename not in EXTRACTS:
        raise KeyError(f"no source is declared for {filename}")
    return EXTRACTS[filename][0]


@dataclass(frozen=True)
class Landed:
    filename: str
    key: str
    size: int
    sha256: str


def land(raw_dir: str | Path, ingest_date: str, backend: Backend) -> list[Landed]:
    """Copy the extracts as they are and write the manifest last, so that a manifest means a whole landing."""
    out = []
    for name in EXTRACTS:
        path = Path(raw_dir) / name
        if not path.exists():
            continue
        body = path.read_bytes()
        key = key_of(source_of(name), ingest_date, name)
        backend.put(key, body)
        out.append(Landed(name, key, len(body), hashlib.sha256(body).hexdigest()))
    backend.put(f"manifest/ingest_date={ingest_date}.json", json.dumps([x.__dict__ for x in out]).encode())
    return out


def manifest(backend: Backend, ingest_date: str) -> list[Landed] | None:
    """None where there is none, or none that can be read."""
    try:
        return [Landed(**x) for x in json.loads(backend.get(f"manifest/ingest_date={ingest_date}.json"))]
    except Exception:
        return None


def changed_since(previous: list[Landed] | None, current: list[Landed]) -> dict[str, list[str]]:
    """new and changed files, and those with the same digest; a file that is gone is no change."""
    old = {x.filename: x.sha256 for x in previous or []}
    kinds: dict[str, list[str]] = {"new": [], "changed": [], "same": []}
    for x in current:
        kinds["new" if x.filename not in old else "same" if old[x.filename] == x.sha256 else "changed"].append(x.filename)
    return kinds


def read_extract(spark: SparkSession, backend: Backend, ingest_date: str, filename: str) -> DataFrame:
    """A scan with the declared schema; empty fields are null. A header that differs is an error, not a shift of columns."""
    source, schema = EXTRACTS[filename]
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(backend.uri(key_of(source, ingest_date, filename)))


def read_lake(spark: SparkSession, backend: Backend, ingest_date: str) -> dict[str, DataFrame]:
    return {name: read_extract(spark, backend, ingest_date, name) for name in EXTRACTS if backend.exists(key_of(source_of(name), ingest_date, name))}


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path and sha256 of the files below a path, by the executors."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
