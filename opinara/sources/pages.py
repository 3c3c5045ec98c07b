"""Review rows from a table of stored HTML pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_relative_date
from ..operators.dedup import top_k_per_group
from ..plans.staging import keep_informative
from ..schemas import PAGE_REVIEW

_VOID = set("area base br col embed hr img input link meta source track wbr".split())


@dataclass(frozen=True)
class Selectors:
    """Where review parts are found on a page.

    Each entry lists alternatives; the first element in page order that matches
    one of them counts.  An alternative is ``tag``, ``tag.class``, ``.class``,
    ``tag[attr]`` or ``[attr=value]``, and may be preceded by such selectors of
    enclosing elements, separated by spaces.
    """

    # --- fixed values: selectors of a map page -------------------------------
    name: tuple[str, ...] = ("h1",)
    address: tuple[str, ...] = (
        "div.Io6YTe.fontBodyMedium.kR99db.fdkmkc", "[data-item-id=address]",
    )
    rating: tuple[str, ...] = ("div.F7nice span span", ".ceNzKf")
    review: tuple[str, ...] = ("div.jftiEf.fontBodyMedium", "div[data-review-id]")
    date: tuple[str, ...] = ("span.rsqaWe", ".DU9Pgb")
    text: tuple[str, ...] = ("span.wiI7pd", ".MyEned")
    star: tuple[str, ...] = ("span.elGi1d",)


_STEP = re.compile(r"([\w-]*)((?:\.[\w-]+)*)(?:\[([\w-]+)(?:=([^\]]*))?\])?$")


def _compile(selector: str) -> list[tuple]:
    """The steps of a selector, innermost first: (tag, classes, attribute, value)."""
    steps = []
    for step in reversed(selector.split()):
        found = _STEP.match(step)
        if not found or not step:
            raise ValueError(f"unsupported selector {selector!r}")
        tag, classes, attr, value = found.groups()
        steps.append((tag, set(filter(None, classes.split("."))), attr, value))
    return steps


def _fits(step: tuple, tag: str, attrs: dict, own: set) -> bool:
    wanted, classes, attr, value = step
    return (
        (not wanted or wanted == tag)
        and classes <= own
        and (attr is None or (attr in attrs and (value is None or attrs[attr] == value)))
    )


class _PageReader(HTMLParser):
    """One pass over a page that collects page parts and review blocks.

    Every open element knows, for each selector, how many of its enclosing steps are met
    on the way down to it, so a tag is matched without looking at what is above it.  Text is
    kept once, in page order; a part is the stretch between an element's start and end.
    """

    PAGE_PARTS = ("name", "address", "rating")
    REVIEW_PARTS = ("date", "text")

    def __init__(self, selectors: dict[str, list[list[tuple]]]):
        super().__init__(convert_charrefs=True)
        self.steps = [(part, steps[::-1]) for part, every in selectors.items() for steps in every]
        self.page: dict[str, list] = {}
        self.reviews: list[dict] = []
        self.texts: list[str] = []
        self.kept: list[list] = []
        self.stars = 0
        # Open elements: tag, steps met per selector, stretches that end with it, own review.
        self.stack: list[tuple[str, tuple[int, ...], list[list], dict | None]] = []
        # The same by kind, so that no step looks through the whole stack.
        self.open: Counter[str] = Counter()
        # Open reviews that still lack a part, by part; an inner one stands behind an outer one.
        self.waiting: dict[str, list[dict]] = {p: [] for p in self.REVIEW_PARTS}

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        own = set((attrs.get("class") or "").split())
        above = self.stack[-1][1] if self.stack else (0,) * len(self.steps)
        met, found = [], set()
        for (part, steps), n in zip(self.steps, above):
            if n == len(steps) - 1:
                if _fits(steps[n], tag, attrs, own):
                    found.add(part)
                met.append(n)
            else:
                met.append(n + _fits(steps[n], tag, attrs, own))
        ends = []

        def stretch() -> list:
            ends.append([len(self.texts), len(self.texts) if tag in _VOID else None])
            return ends[-1]

        for part in self.PAGE_PARTS:
            if part in found and part not in self.page:
                self.page[part] = stretch()
        for part in self.REVIEW_PARTS:
            if part in found and self.waiting[part]:
                one = stretch()
                for review in self.waiting[part]:
                    review[part] = one
                self.waiting[part] = []
        self.stars += "star" in found
        review = None
        if "review" in found:
            review = {"stars": [self.stars, self.stars if tag in _VOID else None]}
            self.reviews.append(review)
        if tag not in _VOID:
            self.stack.append((tag, tuple(met), ends, review))
            self.open[tag] += 1
            if review is not None:
                for part in self.REVIEW_PARTS:
                    self.waiting[part].append(review)

    def handle_endtag(self, tag):
        while self.open[tag]:
            top = self.stack[-1][0]
            self._end()
            if top == tag:
                break

    def _end(self) -> None:
        top, _, ends, review = self.stack.pop()
        self.open[top] -= 1
        for stretch in ends:
            stretch[1] = len(self.texts)
        if review is not None:
            review["stars"][1] = self.stars
            for part in self.REVIEW_PARTS:
                if self.waiting[part] and self.waiting[part][-1] is review:
                    self.waiting[part].pop()

    def close(self):
        super().close()
        while self.stack:
            self._end()
        said: dict[int, str] = {}  # reviews may share a stretch
        for owner, parts in ((self.page, self.PAGE_PARTS), *((r, self.REVIEW_PARTS) for r in self.reviews)):
            for part in parts:
                if part in owner:
                    one = owner[part]
                    if id(one) not in said:
                        said[id(one)] = "".join(self.texts[one[0] : one[1]])
                        self.kept.append(one)
                    owner[part] = said[id(one)]
        for review in self.reviews:
            review["stars"] = review["stars"][1] - review["stars"][0]

    def handle_data(self, data):
        self.texts.append(data)


def _page_rows(page_id, url, html, selectors) -> list[tuple]:
    reader = _PageReader(selectors)
    reader.feed(html or "")
    reader.close()

    def part(owner: dict, name: str) -> str | None:
        return owner[name].strip() if name in owner else None

    page = [part(reader.page, p) for p in reader.PAGE_PARTS]
    return [
        (page_id, url, i, *page, part(r, "date"), part(r, "text"), r["stars"] or None)
        for i, r in enumerate(reader.reviews)
    ]


def pages_to_reviews(pages: DataFrame, selectors: Selectors = Selectors()) -> DataFrame:
    """One row per review block of ``pages(page_id, url, html)``, as found on the page."""
    names = PAGE_REVIEW.fieldNames()
    compiled = {f.name: [_compile(s) for s in getattr(selectors, f.name)] for f in fields(selectors)}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                row for p in batch.itertuples(index=False)
                for row in _page_rows(p.page_id, p.url, p.html, compiled)
            ]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"position": "Int32", "stars": "Int32"})

    return pages.select("page_id", "url", "html").mapInPandas(parse, PAGE_REVIEW)


def branch_name(name, location):
    """Display name and address of a branch."""
    return F.concat(name, F.lit(" - "), location)


def page_reviews_to_raw(
    found: DataFrame, bank: Column | str, city: Column | str, as_of: str, per_branch: int | None = None
) -> DataFrame:
    """Raw review rows from page reviews: defaults, composed names, dates, limits.

    ``bank`` and ``city`` are what was searched for, as texts or as columns; they stand in
    for a missing name and address.  All blocks of a page are used, or the first ``per_branch``, and
    of these the ones with a text or a rating.
    """
    first = found if per_branch is None else top_k_per_group(found, ["page_id"], [F.col("position")], per_branch)
    bank, city = (F.lit(x) if isinstance(x, str) else x for x in (bank, city))
    name = F.coalesce("name", bank)
    place = F.coalesce("address", F.concat(city, F.lit(" - Localisation inconnue")))
    return keep_informative(first.select(
        name.alias("bank_name"), branch_name(name, place).alias("branch_name"),
        F.col("rating").alias("bank_rating"), place.alias("bank_location"),
        F.date_format(parse_relative_date("relative_date", as_of), "yyyy-MM-dd").alias("review_date"),
        "review_text", F.col("stars").alias("review_rating"),
    ))
