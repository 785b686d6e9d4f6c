"""Where tables may live, and the options to reach them; no credentials pass through here."""

from __future__ import annotations

import os
import re

from ..errors import Refused

#: Kinds of storage, their other names and URI schemes.
KINDS = {"adls": ("abfs", "abfss"), "s3": ("s3", "s3a"), "local": ("file", "")}
ALIASES = {"adls_gen2": "adls", "adlsgen2": "adls", "azure": "adls", "minio": "s3", "aws": "s3", "file": "local"}
SECRET = re.compile(r"(key|secret|token|password|sas)", re.I)


def resolve(env: dict[str, str]) -> tuple[str, str, dict[str, str]]:
    """(kind, root, Spark options) from STORAGE_BACKEND, STORAGE_ROOT and the kind's own settings. Local storage has to be allowed."""
    name = env.get("STORAGE_BACKEND", "").strip().lower().replace("-", "_")
    kind, root = ALIASES.get(name, name), env.get("STORAGE_ROOT", "")
    if kind not in KINDS:
        raise Refused(f"no such storage: {name!r}")
    scheme = root.partition("://")[0] if "://" in root else ""
    if not root or root != root.strip() or scheme not in KINDS[kind] or re.search(r"[?#]|\.\.(/|$)", root):
        raise Refused(f"{root!r} isn't a root in {kind}")
    if "@" in root and kind != "adls":
        raise Refused("a root holds no credentials")
    if kind == "local":
        if env.get("STORAGE_ALLOW_LOCAL") != "1":
            raise Refused("local storage isn't allowed here")
        return kind, root, {}
    if kind == "s3":
        endpoint = env.get("S3_ENDPOINT", "")
        if endpoint and not re.match(r"https://|http://(localhost|127\.0\.0\.1)(:|/|\Z)", endpoint):
            raise Refused("an endpoint is reached by https, or on this machine")
        options = {"fs.s3a.endpoint": endpoint, "fs.s3a.endpoint.region": env.get("S3_REGION", ""), "fs.s3a.path.style.access": "true" if endpoint else ""}
        return kind, re.sub(r"\As3://", "s3a://", root), {f"spark.hadoop.{k}": v for k, v in options.items() if v}
    if not re.fullmatch(r"abfss?://[a-z0-9-]+@[a-z0-9]+\.dfs\.core\.windows\.net(/.*)?", root):
        raise Refused(f"{root!r} names no container and account")
    return kind, root, {"spark.hadoop.fs.azure.account.auth.type": env.get("ADLS_AUTH_TYPE", "OAuth")}


def export_target(uri: str, env: dict[str, str]) -> str:
    """The file an export goes to, as Hadoop's file systems name it; it has to lie under the root of the environment's storage, on this machine by its real path."""
    kind, root, _ = resolve(env)
    place, root = re.sub(r"\As3://", "s3a://", uri), root.rstrip("/")
    if uri != uri.strip() or re.search(r"[?#]", uri) or {"..", "."} & set(uri.split("/")) or uri.endswith("/"):
        raise Refused(f"{uri!r} names no file")
    if kind == "local":
        place, root = (os.path.realpath(re.sub(r"\Afile:(//)?(?=/)", "", p)) for p in (place, root))
    if not place.startswith(f"{root}/"):
        raise Refused(f"{uri!r} is outside {root}")
    return place


def kafka_options(env: dict[str, str]) -> dict[str, str]:
    """Options of Spark's Kafka source and sink: PLAINTEXT on this machine only, else SASL over TLS with what the environment names."""
    servers, protocol = env.get("KAFKA_SERVERS", ""), env.get("KAFKA_PROTOCOL", "SASL_SSL")
    hosts = [s.rpartition(":")[0] for s in servers.split(",")]
    if not servers or any(not h or not re.fullmatch(r"[A-Za-z0-9.\-\[\]:]+", h) for h in hosts):
        raise Refused("servers are host:port, separated by commas")
    options = {"kafka.bootstrap.servers": servers, "kafka.security.protocol": protocol}
    if protocol == "PLAINTEXT":
        if any(h not in ("localhost", "127.0.0.1", "[::1]") for h in hosts):
            raise Refused("PLAINTEXT stays on this machine")
        return options
    if protocol != "SASL_SSL" or env.get("KAFKA_MECHANISM") not in ("SCRAM-SHA-256", "SCRAM-SHA-512", "PLAIN"):
        raise Refused("SASL over TLS needs a known mechanism")
    user, password = env.get("KAFKA_USER"), env.get("KAFKA_PASSWORD")
    if not user or not password or '"' in user + password:
        raise Refused("SASL needs a user and a password")
    module = "plain.PlainLoginModule" if env["KAFKA_MECHANISM"] == "PLAIN" else "scram.ScramLoginModule"
    return options | {"kafka.sasl.mechanism": env["KAFKA_MECHANISM"], "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.{module} required username="{user}" password="{password}";'}


def sink_options(env: dict[str, str]) -> dict[str, str]:
    """A producer that waits for all replicas."""
    return kafka_options(env) | {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def described(options: dict[str, str]) -> dict[str, str]:
    """Options for logs: what may be secret is left out."""
    return {k: "***" if SECRET.search(k) or "jaas" in k else v for k, v in options.items()}


def environment() -> dict[str, str]:
    return dict(os.environ)
