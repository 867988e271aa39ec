"""Settings with defaults, kept as JSON, and the policy for failed fetches."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

#: Answers after which a site is left alone. Fixed values.
BLACKLISTING = (403, 404)


@dataclass
class Settings:
    archives_dir: str = "archives"
    output_dir: str = "output"
    max_retries: int = 3
    request_timeout: float = 10.0
    cache_days: int = 30
    rows_per_file: int = 100_000
    api_keys: dict[str, str] = field(default_factory=dict)
    blacklist: list[str] = field(default_factory=list)
    status: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> Settings:
        """Settings of a file; defaults for what it lacks, or if there is none."""
        p = Path(path)
        found = json.loads(p.read_text()) if p.exists() else {}
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in found.items() if k in known})

    def save(self, path: str | Path) -> None:
        Path(path).write_text(json.dumps(asdict(self), indent=2, sort_keys=True))


def after_failure(domain: str, status: int | None, failures: dict[str, int], blacklist: set[str], max_retries: int = 3) -> str:
    """What to do about a site: ``retry`` or ``blacklist``; updates both records."""
    if domain in blacklist:
        return "blacklist"
    failures[domain] = failures.get(domain, 0) + 1
    if status in BLACKLISTING or failures[domain] >= max_retries:
        blacklist.add(domain)
        return "blacklist"
    return "retry"
