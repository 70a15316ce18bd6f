"""Settings of one portal: how its hits look, which months it has, and what its labels are."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from portalmeter import fixed_values as fixed


@dataclass(frozen=True)
class HitRule:
    """One test on one dimension of a hit.

    ``match`` is ``exact``, ``begins_with``, ``ends_with``, ``contains``, ``full_regex`` (the whole value) or ``regex``
    (anywhere in it); case never counts.
    """

    column: str
    match: str
    value: str
    negate: bool = False


@dataclass(frozen=True)
class SectionRule:
    """A counted section: hits whose ``column`` matches ``pattern`` as a whole; no pattern means every hit.

    Hits of a path that matches one of ``excluded_paths`` do not count: as a whole, or for the legacy feed anywhere in it.
    """

    key: str
    name: str
    column: str | None
    pattern: str
    metric: str
    excluded_paths: tuple[str, ...] = ()


def current_section_rules() -> tuple[SectionRule, ...]:
    total = SectionRule("all", "", None, "", "sessions")
    return (total,) + tuple(
        SectionRule("section", name, column, phrases, "eventCount") for name, column, phrases in fixed.CURRENT_SECTIONS
    )


def legacy_section_rules() -> tuple[SectionRule, ...]:
    total = SectionRule("all", "", None, "", "sessions")
    return (total,) + tuple(
        SectionRule("section", name, "section_s2", phrases, "pageviews") for name, phrases in fixed.LEGACY_SECTIONS
    )


@dataclass(frozen=True)
class PortalConfig:
    """Everything that differs between portals. ``portal_host`` is the portal's own host name."""

    portal_host: str = "portal.example.org"
    languages: tuple[str, ...] = fixed.LANGUAGES
    catalogue_segment: str = fixed.CATALOGUE_SEGMENT
    catalogue_phrases: str = fixed.CATALOGUE_PHRASES
    hostname_pattern: str | None = None
    excluded_package_paths: tuple[str, ...] = ()
    excluded_resource_names: tuple[str, ...] = ("new",)
    extra_rule: HitRule | None = None
    current_sections: tuple[SectionRule, ...] = field(default_factory=current_section_rules)
    legacy_sections: tuple[SectionRule, ...] = field(default_factory=legacy_section_rules)
    cutover_month: str = "2023-06"
    month_names: tuple[str, ...] = fixed.MONTH_NAMES

    @property
    def language_prefix_pattern(self) -> str:
        return "(?:|" + "|".join("/" + re.escape(language) for language in self.languages) + ")"

    @property
    def dataset_page_pattern(self) -> str:
        """Whole path of a dataset page; group 1 is the dataset's name or id."""
        return f"^{self.language_prefix_pattern}/{re.escape(self.catalogue_segment)}/({fixed.NAME_PATTERN})/?$"

    @property
    def excluded_resource_paths(self) -> tuple[str, ...]:
        start = f"{self.language_prefix_pattern}/{re.escape(self.catalogue_segment)}/"
        return tuple(f"{start}{name}/?" for name in self.excluded_resource_names)

    @property
    def dataset_url_prefix(self) -> str:
        return f"https://{self.portal_host}/{self.languages[0]}/{self.catalogue_segment}/"

    def sections(self, feed: str) -> tuple[SectionRule, ...]:
        return self.current_sections if feed == "current" else self.legacy_sections
