"""Saved pages to raw rows: all fields as texts, a page that can't be read as a row with its error.

A page becomes a list of its elements with their own text; readers look elements up by tag and class, which
plans can't express. Pages are independent: no shuffle, one page in memory at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places of the fields in the pages, as tag and class.
LINK = ("a", "b-link")
PERSON = ("a", "b-fight-details__person-link")
TITLE = ("i", "b-fight-details__fight-title")
OUTCOME = ("i", "b-fight-details__person-status")
LABEL = (None, "b-fight-details__label")
OFFICIAL = ("i", "b-fight-details__text-item")
NAME = ("span", "b-content__title-highlight")
NICKNAME = ("p", "b-content__Nickname")
RECORD = ("span", "b-content__title-record")
BOX = ("li", "b-list__box-list-item")
COLUMN = ("th", "b-fight-details__table-col")
HEAD, ROUND_HEAD = "b-fight-details__table-head", "b-fight-details__table-row"
CELL = ("p", "b-fight-details__table-text")
TOTALS = ["KD", "Sig. str.", "Sig. str. %", "Total str.", "Td", "Td %", "Sub. att", "Rev.", "Ctrl"]
TARGETS = ["Sig. str", "Sig. str. %", "Head", "Body", "Leg", "Distance", "Clinch", "Ground"]
VOID = {"br", "img", "hr", "input", "meta", "link", "col", "area", "base", "embed", "source", "track", "wbr"}


def squeeze(text: str | None) -> str:
    return re.sub(r"\s+", " ", text or "").strip()


def page_id(url: str) -> str:
    return str(uuid5(NAMESPACE_URL, url.replace("://www.", "://")))


class Element:
    __slots__ = ("tag", "classes", "attrs", "parent", "own", "after")

    def __init__(self, tag: str, attrs: dict, parent: "Element | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = (attrs.get("class") or "").split()
        self.own: list[str] = []  # its text, without that of elements inside
        self.after: list[str] = []  # the text that follows it within its parent


class Page(HTMLParser):
    """The elements of a page in order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self._open: list[Element] = []
        self._last: dict[int, Element] = {}
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self._open[-1] if self._open else None)
        self.elements.append(e)
        self._last[id(e.parent)] = e
        if tag not in VOID:
            self._open.append(e)

    def handle_endtag(self, tag):
        for i in reversed(range(len(self._open))):
            if self._open[i].tag == tag:
                del self._open[i:]
                return

    def handle_data(self, data):
        parent = self._open[-1] if self._open else None
        if parent is not None:
            parent.own.append(data)
        if id(parent) in self._last:
            self._last[id(parent)].after.append(data)

    def find(self, place: tuple, inside: str | None = None) -> list[Element]:
        tag, name = place
        return [e for e in self.elements if (tag is None or e.tag == tag) and name in e.classes and (inside is None or self._within(e, inside))]

    @staticmethod
    def _within(e: Element, name: str) -> bool:
        while e.parent is not None:
            e = e.parent
            if name in e.classes:
                return True
        return False

    def texts(self, place: tuple, inside: str | None = None) -> list[str]:
        """Own text of each element, one entry for each piece of it."""
        return [t for e in self.find(place, inside) for t in e.own]

    def first(self, place: tuple) -> str:
        found = [squeeze(t) for t in self.texts(place) if squeeze(t)]
        if not found:
            raise ValueError(f"no {place[1]}")
        return found[0]

    def hrefs(self, containing: str = "") -> list[str]:
        return [e.attrs["href"] for e in self.elements if e.tag == "a" and containing in e.attrs.get("href", "")]

    def labelled(self, label: str) -> tuple[str, str]:
        """(text after the label, text of the element after it)."""
        for k, e in enumerate(self.elements):
            if LABEL[1] in e.classes and label in "".join(e.own):
                following = next((x for x in self.elements[k + 1 :] if x.parent is e.parent), None)
                return squeeze("".join(e.after)), squeeze("".join(following.own)) if following else ""
        raise ValueError(f"no label {label}")


def read_event(url: str, page: Page) -> list[dict]:
    box = page.texts(BOX)
    date, place = (squeeze(box[i]) if len(box) > i else "" for i in (1, 3))
    fights = page.hrefs("fight-details")
    return [{"event_id": page_id(url), "url": url, "name": page.first(NAME), "date": date, "location": place, "fights": ", ".join(map(page_id, fights)), "fight_urls": ", ".join(fights)}]


def read_fight(url: str, page: Page) -> list[dict]:
    events, people, outcomes = page.hrefs("event-details"), page.hrefs("fighter-details"), [squeeze(t) for t in page.texts(OUTCOME)]
    method, minutes = page.labelled("Method:")[1], page.labelled("Time:")[0].split(":")
    decided = "decision" in method.lower() and " - " in method
    try:
        details = page.labelled("Details:")[0]
    except ValueError:
        details = ""
    officials = [squeeze("".join(e.own)) for x in page.find(OFFICIAL) for e in page.elements if e.parent is x and e.tag == "span"]
    judges = (officials[1:] + ["", "", ""])[:3]
    return [{
        "fight_id": page_id(url), "url": url, "event_id": page_id(events[0]), "fighter_1_id": page_id(people[0]), "fighter_2_id": page_id(people[1]), "fighter_1_outcome": outcomes[0], "fighter_2_outcome": outcomes[1], "bout_type": page.first(TITLE),
        "num_rounds": re.match(r"\d+", page.labelled("Time format:")[0]).group() if "Time format:" in "".join(page.texts(LABEL)) else page.labelled("Round:")[0], "finish_method": method, "primary_finish_method": method.split(" - ")[0].lower() if decided else method.lower(), "secondary_finish_method": method.split(" - ")[1].lower() if decided else details.lower(),
        "finish_round": page.labelled("Round:")[0], "finish_time_minute": minutes[0], "finish_time_second": minutes[1], "referee": page.labelled("Referee:")[1], "judge_1": judges[0], "judge_2": judges[1], "judge_3": judges[2],
    }]


def read_fighter(url: str, page: Page) -> list[dict]:
    box = page.texts(BOX)
    at = lambda i: squeeze(box[i]) if len(box) > i and squeeze(box[i]) != "--" else ""
    names = page.first(NAME).split(" ")
    nick = [squeeze(t) for t in page.texts(NICKNAME)]
    fights = page.hrefs("fight-details")
    return [{"fighter_id": page_id(url), "url": url, "full_name": " ".join(names), "first_name": names[0], "last_names": " ".join(names[1:]), "nickname": nick[0] if nick else "", "height": at(1), "weight": at(3), "reach": at(5), "stance": at(7), "dob": at(9), "record": page.first(RECORD).removeprefix("Record: "), "fight_ids": ", ".join(map(page_id, fights))}]


def _stats(url: str, page: Page) -> tuple[list[str], int, list[dict[tuple, str]]]:
    heads = [h for h in map(squeeze, page.texts(COLUMN, HEAD)) if h and h != "Fighter"]
    if heads != TOTALS + TARGETS:
        raise ValueError(f"unexpected columns {heads}")
    rounds = len([h for h in map(squeeze, page.texts(COLUMN, ROUND_HEAD)) if h]) // 2
    keys = [(h, r) for names in (TOTALS, TARGETS) for r in range(rounds + 1) for h in names]  # round 0: the bout
    values = [v for v in map(squeeze, page.texts(CELL)) if v]
    if len(values) != 2 * len(keys):
        raise ValueError(f"{len(values)} cells for {len(keys)} columns of two sides")
    return [page_id(e.attrs["href"]) for e in page.find(PERSON)][:2], rounds, [dict(zip(keys, values[i::2])) for i in (0, 1)]


def _stat_fields(v: dict[tuple, str], r: int) -> dict:
    pair = lambda t: (re.findall(r"(\d+) of (\d+)", t) or [("0", "0")])[0]
    out = {"knockdowns": v["KD", r], "submissions_attempted": v["Sub. att", r], "reversals": v["Rev.", r]}
    clock = v["Ctrl", r].split(":")
    out |= dict(zip(("control_time_minutes", "control_time_seconds"), clock if len(clock) == 2 and "".join(clock).isdigit() else ("0", "0")))
    for name, head in {"total_strikes_{}": "Total str.", "significant_strikes_{}": "Sig. str.", "takedowns_{}": "Td", **{f"significant_strikes_{{}}_{h.lower()}": h for h in TARGETS[2:]}}.items():
        out[name.format("landed")], out[name.format("attempted")] = pair(v[head, r])
    return out


def _read_stats(by_round: bool) -> Callable[[str, Page], list[dict]]:
    def read(url: str, page: Page) -> list[dict]:
        if not page.find(CELL):
            return []  # bouts without stats have no table
        people, rounds, sides = _stats(url, page)
        fight = page_id(url)
        return [{"fight_id": fight, "fighter_id": p, "url": url} | ({"round": str(r), "fight_stat_by_round_id": page_id(f"{fight}{p}{r}")} if by_round else {"fight_stat_id": page_id(fight + p)}) | _stat_fields(v, r) for p, v in zip(people, sides) for r in (range(1, rounds + 1) if by_round else (0,))]

    return read


READERS = {"event": read_event, "fight": read_fight, "fighter": read_fighter, "fight_stats": _read_stats(False), "fight_stats_by_round": _read_stats(True)}


def read_pages_as(pages: DataFrame, kind: str, url: str = "url", html: str = "html") -> DataFrame:
    """(url, fields, error): raw rows of each page, fields as a map of texts. A page that can't be read is one row with
    its error and no fields; a null or empty page is one with 'no page'; a page without the wanted table gives no row."""
    read = READERS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls, fields, errors = [], [], []
            for u, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    if not t:
                        raise ValueError("no page")
                    rows = [(list(x.items()), None) for x in read(u or "", Page(t))]
                except (ValueError, IndexError, KeyError) as e:
                    rows = [(None, str(e) or type(e).__name__)]
                for f, e in rows:
                    urls.append(u)
                    fields.append(f)
                    errors.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(fields, pa.map_(pa.string(), pa.string())), pa.array(errors, pa.string())], ["url", "fields", "error"])

    return pages.select(F.col(url).cast("string"), F.col(html).cast("string")).mapInArrow(run, "url string, fields map<string,string>, error string")
