"""Search profiles from YAML, strictly checked on the driver."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

DATES = ("any", "past_24_hours", "past_week", "past_month")


def _only(cls, values: dict, where: str) -> dict:
    if not isinstance(values, dict):
        raise ValueError(f"{where} must be a mapping")
    if unknown := set(values) - {f.name for f in fields(cls)}:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}")
    return values


def _within(value, low, high, name: str):
    if value is not None and (isinstance(value, bool) or not isinstance(value, (int, float)) or not low <= value <= high):
        raise ValueError(f"{name} must be from {low} to {high}")


@dataclass
class Filters:
    date_posted: str = "past_week"
    experience_levels: list[str] = field(default_factory=lambda: ["mid_senior"])
    workplace_types: list[str] = field(default_factory=lambda: ["remote"])
    employment_types: list[str] = field(default_factory=lambda: ["full_time", "contract"])
    sort_by: str = "recent"

    def __post_init__(self):
        if self.date_posted not in DATES or self.sort_by not in ("relevant", "recent"):
            raise ValueError("unknown date_posted or sort_by")


@dataclass
class Profile:
    id: str
    keywords: str
    location: str | None = None
    max_results: int | None = None
    enabled: bool = True
    filters: Filters | None = None

    def __post_init__(self):
        if not re.match(r"^[a-z0-9][a-z0-9_-]*$", self.id):
            raise ValueError("a profile's id must be a slug")
        self.keywords = self.keywords.strip()
        self.location = self.location and self.location.strip()
        if not self.keywords or self.location == "":
            raise ValueError("keywords and location must not be blank")
        _within(self.max_results, 1, 5000, "max_results")


#: Bounds of a live session's settings, kept for configurations that have them: fixed values.
SESSION_BOUNDS = {
    "page_load_timeout": (5, 180), "wait_timeout": (2, 120), "scroll_pause_min": (0.1, 30), "scroll_pause_max": (0.1, 60), "stagnation_limit": (1, 20),
    "max_scroll_rounds": (1, 5000), "search_deadline_seconds": (10, 7200), "debug_pause_after_first_request_seconds": (0, 3600),
}


@dataclass
class Session:
    """Settings of a live search session. The engine reads max_scroll_rounds and stagnation_limit; the rest is checked only."""

    profile_dir: str = ".browser-profile"
    headless: bool = False
    incognito: bool = False
    use_uc: bool = False
    locale_code: str = "en-US"
    window_size: str = "1440,1000"
    page_load_timeout: int = 45
    wait_timeout: int = 20
    scroll_pause_min: float = 1.0
    scroll_pause_max: float = 2.0
    stagnation_limit: int = 3
    max_scroll_rounds: int = 250
    search_deadline_seconds: int = 900
    debug_pause_after_first_request_seconds: float = 0

    def __post_init__(self):
        for name, (low, high) in SESSION_BOUNDS.items():
            _within(getattr(self, name), low, high, name)
        if self.scroll_pause_max < self.scroll_pause_min:
            raise ValueError("scroll_pause_max must not be less than scroll_pause_min")


@dataclass
class Config:
    profiles: list[Profile]
    location: str = "Worldwide"
    max_results: int = 500
    page_size: int = 25
    filters: Filters = field(default_factory=Filters)
    database: str = "data/listings"
    refresh_existing: bool = False
    session: Session = field(default_factory=Session)

    def __post_init__(self):
        _within(self.max_results, 1, 5000, "max_results")
        _within(self.page_size, 1, 100, "page_size")
        if len({p.id for p in self.profiles}) != len(self.profiles):
            raise ValueError("profile ids must be unique")

    def profile(self, name: str, direct: bool = False) -> Profile:
        found = next((p for p in self.profiles if p.id == name), None)
        if found is None:
            raise KeyError(f"unknown profile {name!r}; there are: {', '.join(p.id for p in self.profiles)}")
        if not found.enabled and not direct:
            raise ValueError(f"profile {name!r} is disabled")
        return found

    def resolved(self, name: str, **given) -> dict:
        """A search's settings: what is given, then the profile's, then the defaults."""
        p = self.profile(name)
        limit = given.get("max_results")
        if limit is not None and limit < 1:
            raise ValueError("max_results must be positive")
        return {"keywords": given.get("keywords") or p.keywords, "location": given.get("location") or p.location or self.location, "max_results": limit or p.max_results or self.max_results, "filters": p.filters or self.filters}


def load(path: str) -> Config:
    import yaml

    top = yaml.safe_load(Path(path).expanduser().read_text(encoding="utf-8")) or {}
    if unknown := set(top) - {"database", "refresh_existing", "browser", "defaults", "searches"}:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    defaults = dict(top.get("defaults") or {})
    if unknown := set(defaults) - {"location", "max_results", "page_size", "filters"}:
        raise ValueError(f"defaults: unknown keys {sorted(unknown)}")
    if "filters" in defaults:
        defaults["filters"] = Filters(**_only(Filters, defaults["filters"], "filters"))
    profiles = []
    for s in top.get("searches") or []:
        s = dict(_only(Profile, s, "search"))
        if s.get("filters"):
            s["filters"] = Filters(**_only(Filters, s["filters"], "filters"))
        profiles.append(Profile(**s))
    session = Session(**_only(Session, top.get("browser") or {}, "browser"))
    return Config(profiles, **defaults, session=session, **{k: top[k] for k in ("database", "refresh_existing") if k in top})


def boolean(value) -> bool:
    """Of an argument: 1/true/yes/on or 0/false/no/off."""
    v = str(value).strip().lower()
    if v in ("1", "true", "yes", "on"):
        return True
    if v in ("0", "false", "no", "off"):
        return False
    raise ValueError(f"not a boolean: {value!r}")


def resolved_path(value: str, config: str | None = None) -> Path:
    """A path that a configuration names: absolute as it is; relative to the working folder without a configuration file,
    to the checkout for one in its config/ folder, else to the file's own folder."""
    path = Path(value).expanduser()
    if path.is_absolute():
        return path
    if config is None:
        return (Path.cwd() / path).resolve()
    folder = Path(config).expanduser().resolve().parent
    checkout = folder.name == "config" and any((folder.parent / name).is_file() for name in ("pyproject.toml", "bench.py"))
    return ((folder.parent if checkout else folder) / path).resolve()


def first_option(options: dict, *names: str):
    """The first of the options that is there and not empty."""
    return next((options[n] for n in names if options.get(n) not in (None, "")), None)


#: Names under which a run's options may come, in order: fixed values.
RUN_OPTIONS = {
    "source": ("source",), "search_profile_id": ("search_profile_id", "profile_id", "search_id"), "query": ("query", "keywords"), "location": ("location", "search_location"),
    "search_url": ("search_url", "start_url"), "requested_limit": ("max_jobs", "max_results", "requested_limit", "limit"), "config": ("run_metadata", "run_config", "search_config", "config"), "run_uuid": ("run_id",),
}


def run_options(options: dict) -> dict:
    """A run's metadata from options under any of their names; the source is 'other' without one."""
    found = {field: first_option(options, *names) for field, names in RUN_OPTIONS.items()}
    return found | {"source": found["source"] or "other"}


#: Settings by name: environment variable and default.
SETTINGS = {"store": ("LEDGERMILL_STORE", "data/listings"), "batch_rows": ("LEDGERMILL_BATCH_ROWS", "1000000"), "writer_timeout": ("LEDGERMILL_WRITER_TIMEOUT", "10")}


def setting(name: str, given=None, configured=None, environ=None) -> str:
    """What is given, else the environment's, else the configuration's, else the default."""
    variable, default = SETTINGS[name]
    return str(next(v for v in (given, (os.environ if environ is None else environ).get(variable), configured, default) if v not in (None, "")))
