"""Browser, operating system and device read from a user agent text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabloom.functions.text import contains_any

# Browser markers from the weakest rule to the strongest; Safari also needs the absence of a second list.
BROWSER_MARKERS = (
    ("Edge", ("edg", "edge")),
    ("Opera", ("opr", "opera")),
    ("Firefox", ("firefox",)),
    ("Chrome", ("chrome", "crios")),
    ("Safari", ("safari",)),
    ("Internet Explorer", ("msie", "trident")),
)
NOT_SAFARI = ("chrome", "crios", "chromium", "edg", "edge", "opr", "opera")

# Operating system markers from the weakest rule to the strongest.
OS_MARKERS = (
    ("Windows", ("windows nt", "win64", "win32", "windows")),
    ("macOS", ("mac os x", "macintosh")),
    ("Android", ("android",)),
    ("iOS", ("iphone", "ipad", "ios")),
    ("Linux", ("linux",)),
)

# Device words, the first one that occurs wins.
DEVICE_WORDS = ("Windows", "Linux", "Android", "iPad", "iPod", "iPhone", "Macintosh")


def _strongest(rules: list[tuple[str, Column]], default: str) -> Column:
    """CASE over rules listed from weak to strong, so the strong ones are tested first."""
    return F.coalesce(*(F.when(test, F.lit(name)) for name, test in reversed(rules)), F.lit(default))


def browser_of(agent: Column) -> Column:
    rules = []
    for name, parts in BROWSER_MARKERS:
        test = contains_any(agent, *parts)
        if name == "Safari":
            test = test & ~contains_any(agent, *NOT_SAFARI)
        rules.append((name, test))
    return _strongest(rules, "Other")


def os_of(agent: Column) -> Column:
    return _strongest([(name, contains_any(agent, *parts)) for name, parts in OS_MARKERS], "Other")


def device_of(agent: Column) -> Column:
    """The first listed device word found, spelled as in the text."""
    found = (F.nullif(F.regexp_extract(agent, f"(?i){word}", 0), F.lit("")) for word in DEVICE_WORDS)
    return F.coalesce(*found, F.lit("Unknown"))
