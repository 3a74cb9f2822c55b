"""Parameters of a run."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from factspark.functions.dates import start_of
from factspark.fixed import ID_PREFIX


@dataclass(frozen=True)
class RewriteConfig:
    """Parameters of a rewriting service; its key is read from the environment where the client runs."""

    provider: str
    model: str
    api_key_env: str
    base_url: str | None = None
    proxy: str | None = None
    temperature: float = 0.0
    max_tokens: int = 256


@dataclass(frozen=True)
class Settings:
    """``target_time`` is a year, a month or a day: subjects must not be older than its first day."""

    target_time: str
    run_date: str = field(default_factory=lambda: datetime.date.today().isoformat())
    date_upper_bound: str | None = None
    pilot_total: int = 20
    harvest_limit_per_template: int = 100
    #: Raw rows are kept up to this many times the limit, after the uniqueness filter.
    over_fetch: int = 5
    competitor_limit: int = 10
    allow_year_in_official_title: bool = False
    id_prefix: str = ID_PREFIX
    #: The dedup of questions starts anew with each template, as in separate runs.
    separate_templates: bool = False
    rewrite: RewriteConfig | None = None
    # Stricter or wider rules of the design; off by default.
    #: Competitors are found by all names of both sides, not by labels alone.
    alias_competitors: bool = False
    #: A subject with competitors is asked for by the smallest set of descriptors, of up to three, that none of them has.
    signatures: bool = False
    #: An answer must be the only one among all statements that aren't deprecated, without a qualifier of time.
    full_statements: bool = False
    #: Further phrases count as temporal text.
    extra_phrases: bool = False
    #: Properties whose values change have reasons of their own, and one more of them counts.
    finer_reasons: bool = False
    #: Examples by quotas of this column (domain, topic, answer_type or question_family), several of a template, instead of one of each.
    quota_by: str | None = None
    #: With quotas, a subject and a property are asked for once.
    dedup_subject_property: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "target_time", self.target_time.strip())
        start_of(self.target_time)
        datetime.date.fromisoformat(self.run_date)
        if self.quota_by not in (None, "domain", "topic", "answer_type", "question_family"):
            raise ValueError(f"no quotas by {self.quota_by}")
        if self.date_upper_bound is None:
            object.__setattr__(self, "date_upper_bound", self.run_date)

    @property
    def target_start_date(self) -> str:
        return start_of(self.target_time)
