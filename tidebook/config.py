"""Settings of a collection from the environment and a dotenv file; the environment wins."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Field names in capitals are the variables. Values below a minimum raise ValueError; addresses have
    no default."""

    data_dir: str = "data"
    max_markets: int = 75
    min_daily_reward: float = 0.0
    min_volume_24h: float = 0.0
    discovery_interval_seconds: int = 900
    rotation_seconds: int = 900
    max_file_mib: int = 64
    flush_interval_seconds: int = 2
    health_host: str = "127.0.0.1"
    health_port: int = 8080
    stale_after_seconds: int = 180
    log_level: str = "INFO"
    book_checkpoint_interval_seconds: int = 300
    collect_sports: bool = True
    collect_rtds_crypto: bool = True
    clob_base_url: str = ""
    gamma_base_url: str = ""
    websocket_url: str = ""
    sports_websocket_url: str = ""
    rtds_websocket_url: str = ""

    def __post_init__(self) -> None:
        least = {"max_markets": 1, "min_daily_reward": 0, "min_volume_24h": 0, "discovery_interval_seconds": 30, "rotation_seconds": 60, "max_file_mib": 1, "flush_interval_seconds": 1, "health_port": 1, "stale_after_seconds": 30, "book_checkpoint_interval_seconds": 0}
        if wrong := [f"{k.upper()} must be at least {v}" for k, v in least.items() if getattr(self, k) < v]:
            raise ValueError("; ".join(wrong))


def read_dotenv(path: str | Path) -> dict[str, str]:
    """KEY=value lines; blank lines and # comments are skipped, quotes around values dropped."""
    file = Path(path)
    out: dict[str, str] = {}
    for line in file.read_text(encoding="utf-8").splitlines() if file.exists() else []:
        name, sign, value = line.strip().partition("=")
        if sign and not name.startswith("#"):
            out[name.strip()] = value.strip().strip("\"'")
    return out


def from_env(dotenv: str | Path | None = None, environ: dict[str, str] | None = None) -> Config:
    """From the environment and a dotenv file: `dotenv`, else the variable ENV_FILE, else .env. PORT stands
    in for HEALTH_PORT where only it is set."""
    environ = dict(os.environ if environ is None else environ)
    found = read_dotenv(dotenv or environ.get("ENV_FILE", ".env")) | environ
    found.setdefault("HEALTH_PORT", found.get("PORT", ""))
    values = {}
    for field in fields(Config):
        if (text := found.get(field.name.upper(), "")) == "":
            continue
        if isinstance(field.default, bool):
            if text.strip().lower() not in ("true", "1", "yes", "on", "false", "0", "no", "off"):
                raise ValueError(f"{field.name.upper()} is not a boolean: {text}")
            values[field.name] = text.strip().lower() in ("true", "1", "yes", "on")
        else:
            values[field.name] = type(field.default)(text)
    for name, value in values.items():
        if name.endswith("_url"):
            values[name] = value.rstrip("/")
    if "log_level" in values:
        values["log_level"] = values["log_level"].upper()
    return Config(**values)
