"""Extraction against a walk over random trees, many pages in one job."""

import html as html_text
import random
import re

from orgloom.plans.extraction import page_facts
from orgloom.schemas import HEADING_COLUMNS, PAGE_SCHEMA, ExtractionSpec

SPEC = ExtractionSpec()
TAGS = ["div", "p", "dl", "dt", "dd", "ul", "li", "button", "span", "strong", "h1", "h2", "b"]
CLASSES = [SPEC.title_class, SPEC.header_class, SPEC.bar_class, SPEC.category_class, "x"]
TEXTS = [*HEADING_COLUMNS, " Company size ", "11-50 employees", " 1,200 associated members", "a & b", " ", "7", " x\n"]


class Element:
    def __init__(self, rng, tag, depth):
        self.tag, self.attrs, self.children = tag, {}, []
        if rng.random() < 0.5:
            self.attrs["class"] = " ".join(rng.sample(CLASSES, rng.randint(1, 2)))
        if tag == "li" and rng.random() < 0.8:
            self.attrs[SPEC.item_attr] = rng.choice("0012")
        for _ in range(rng.randint(0, 5) if depth else 0):
            if self.children and isinstance(self.children[-1], Element) and rng.random() < 0.3:
                self.children.append(rng.choice(TEXTS))
            self.children.append(Element(rng, rng.choice(TAGS), depth - 1))
        if rng.random() < 0.8:
            self.children.append(rng.choice(TEXTS))

    def html(self):
        attrs = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        inner = "".join(html_text.escape(c) if isinstance(c, str) else c.html() for c in self.children)
        return f"<{self.tag}{attrs}>{inner}</{self.tag}>"

    def texts(self):
        for child in self.children:
            if isinstance(child, str):
                yield child
            else:
                yield from child.texts()

    def walk(self):
        for child in self.children:
            if isinstance(child, Element):
                yield child
                yield from child.walk()

    def raw(self):
        return "".join(self.texts()).strip()

    def tight(self):
        return "".join(t.strip() for t in self.texts())

    def has(self, token):
        return token in self.attrs.get("class", "").split()


def first(elements, tag, token=None):
    return next((e for e in elements if e.tag == tag and (token is None or e.has(token))), None)


def count_of(text):
    found = re.search(r"([\d,]+)\s*associated member", text)
    return found and found[1]


def expected_profile(root):
    values = dict.fromkeys(HEADING_COLUMNS, "-")
    after = {}
    for parent in [root, *root.walk()]:
        siblings = [c for c in parent.children if isinstance(c, Element)]
        for i, dt in enumerate(siblings):
            if dt.tag == "dt":
                after[id(dt)] = [s for s in siblings[i + 1 :] if s.tag == "dd"]
    for dt in root.walk():
        following = after.get(id(dt))
        if dt.tag != "dt" or not following or dt.tight() not in values:
            continue
        text = following[0].tight()
        if dt.tight() != "Company size":
            values[dt.tight()] = text
            continue
        size = re.search(r"^(.*)employees", text)
        if size:
            values["Company size"] = "'" + re.match(r"(.*?)\s*$", size[1])[1].strip()
        members = count_of(following[1].tight()) if len(following) > 1 else None
        if members:
            values["No. of associated members"] = members
    return {HEADING_COLUMNS[h]: v for h, v in values.items()}


def expected_bars(root, index):
    item = next((e for e in root.walk() if e.tag == "li" and e.attrs.get(SPEC.item_attr) == index), None)
    bars = []
    for button in item.walk() if item else ():
        if button.tag == "button" and button.has(SPEC.bar_class):
            inner = list(button.walk())
            strong, category = first(inner, "strong"), first(inner, "span", SPEC.category_class)
            label = category.raw() if category else None if first(inner, "span") else "-"
            bars.append((label, strong.raw() if strong else "-"))
    return bars


def test_random_pages(spark):
    rng = random.Random(7)
    roots = []
    for _ in range(2000):
        root = Element(rng, "html", 0)
        root.attrs, root.children = {}, [Element(rng, rng.choice(TAGS), 4) for _ in range(rng.randint(1, 5))]
        roots.append(root)
    rows = [(str(i), str(i), root.html(), None) for i, root in enumerate(roots)]
    facts = page_facts(spark.createDataFrame(rows, PAGE_SCHEMA).repartition(8), SPEC)
    found = {int(r.requested_url): r for r in facts.collect()}
    assert len(found) == len(roots)
    seen = {"profile": 0, "bars": 0, "bad": 0, "members": 0}
    for i, root in enumerate(roots):
        r, elements = found[i], list(root.walk())
        h1, title = first(elements, "h1"), first(elements, "h1", SPEC.title_class)
        assert r.heading == (h1.raw() if h1 else None)
        assert r.title == (title.tight() if title else None)
        header = first(elements, "div", SPEC.header_class)
        h2 = first(header.walk(), "h2") if header else None
        assert r.header_members == (count_of(h2.tight()) if h2 else None)
        assert r.has_bars == any(e.has(SPEC.bar_class) for e in elements)
        assert r.profile.asDict() == expected_profile(root)
        for facet, index in (("locations", "0"), ("roles", "2")):
            bars = [tuple(b) for b in r[facet]]
            assert bars == expected_bars(root, index)
            seen["bars"] += len(bars)
            seen["bad"] += any(label is None for label, _ in bars)
        seen["profile"] += any(v != "-" for v in r.profile.asDict().values())
        seen["members"] += r.header_members is not None
    assert min(seen.values()) > 5, seen
