"""Page text -> element rows; the only Python that runs per page.

The rules are those of a lenient tree built over the standard-library HTML
tokenizer: no implied end tags, void elements close themselves, an end tag
closes back to its nearest open match and is ignored without one.
"""

from __future__ import annotations

import re
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa

# Elements that never have content (current and obsolete ones).
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text is not part of the surrounding text.
HIDDEN = frozenset({"script", "style", "template", "rt", "rp"})
# Elements whose white space is kept as it is.
PREFORMATTED = frozenset({"pre", "textarea"})
# Elements whose content some versions of the tokenizer read as plain text.
RAW_TEXT = frozenset(
    {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"}
)
ASCII_SPACE = " \n\t\f\r"

# Tags in the usual form, which need none of the tokenizer's care for broken ones.
USUAL_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?:[ \n]+[a-zA-Z][-a-zA-Z0-9]*="[^"&]*")*)[ \n]*>')
USUAL_ATTRIBUTE = re.compile(r'([a-zA-Z][-a-zA-Z0-9]*)="([^"&]*)"')
USUAL_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")

NODE_FIELDS = {
    "node_id": pa.int32(),
    "parent_id": pa.int32(),
    "last_desc_id": pa.int32(),
    "pos": pa.int32(),
    "n_inner": pa.int32(),
    "tag": pa.string(),
    "classes": pa.list_(pa.string()),
    "attrs": pa.map_(pa.string(), pa.string()),
    "text_from": pa.int32(),
    "text_count": pa.int32(),
}
NODE_TYPE = pa.struct(list(NODE_FIELDS.items()))


class Pages:
    """The elements and text nodes of several pages, column by column."""

    def __init__(self):
        self.nodes = {name: [] for name in NODE_FIELDS}
        self.texts = []
        self.node_ends, self.text_ends, self.errors = [0], [0], []

    def end_page(self, error=None):
        """Close the page at hand; with an error it is left without content."""
        if error is not None:
            for column in self.nodes.values():
                del column[self.node_ends[-1] :]
            del self.texts[self.text_ends[-1] :]
        self.node_ends.append(len(self.nodes["tag"]))
        self.text_ends.append(len(self.texts))
        self.errors.append(error)

    def arrays(self):
        """``nodes``, ``texts`` and ``parse_error``, one row per page."""
        failed = pa.array([error is not None for error in self.errors], pa.bool_())
        columns = [pa.array(self.nodes[name], kind) for name, kind in NODE_FIELDS.items()]
        nodes = pa.StructArray.from_arrays(columns, fields=list(NODE_TYPE))
        return {
            "nodes": pa.ListArray.from_arrays(pa.array(self.node_ends, pa.int32()), nodes, mask=failed),
            "texts": pa.ListArray.from_arrays(
                pa.array(self.text_ends, pa.int32()), pa.array(self.texts, pa.string()), mask=failed
            ),
            "parse_error": pa.array(self.errors, pa.string()),
        }


class PageTokenizer(HTMLParser):
    """Collects the wanted elements and text nodes of one page in document order.

    ``keep_tags=None`` keeps every element. Otherwise an element is kept for its
    tag, for one of its classes or for one of its attributes. A text node is kept
    once, if some element of ``text_tags`` is around it, and these elements tell
    where their text nodes start and how many there are. So the result is never
    larger than the page, however deep its elements are nested. ``text_tags=None``
    keeps the text of every element.
    """

    def __init__(self, keep_tags, keep_classes, keep_attrs, text_tags):
        super().__init__(convert_charrefs=False)
        self.keep_tags, self.keep_classes = keep_tags, keep_classes
        self.keep_attrs, self.text_tags = keep_attrs, text_tags

    def read(self, html, pages):
        """Append one page to ``pages``; the caller ends it."""
        self.reset()
        self.nodes, self.texts, self.data = pages.nodes, pages.texts, []
        self.first_node, self.first_text = len(pages.nodes["tag"]), len(pages.texts)
        self.last_id = -1
        self.open, self.open_names = [], {}  # open: (name, id, row or None)
        self.listeners = self.hidden = self.preformatted = 0
        self.feed(html)
        self.close()
        self._end_text()
        while self.open:
            self._pop()

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def parse_starttag(self, i):
        usual = USUAL_START.match(self.rawdata, i)
        tag = usual and usual[1].lower()
        if not usual or tag in RAW_TEXT:
            return super().parse_starttag(i)
        self.handle_starttag(tag, [(k.lower(), v) for k, v in USUAL_ATTRIBUTE.findall(usual[2])] if usual[2] else ())
        return usual.end()

    def parse_endtag(self, i):
        usual = USUAL_END.match(self.rawdata, i)
        if not usual or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(usual[1].lower())
        return usual.end()

    def _end_text(self):
        if not self.data:
            return
        text = "".join(self.data)
        self.data.clear()
        if not self.preformatted and not text.strip(ASCII_SPACE):
            text = "\n" if "\n" in text else " "
        self.texts.append(text)

    def _wanted(self, tag, classes, attrs):
        if self.keep_tags is None or tag in self.keep_tags:
            return True
        return bool(attrs) and not (self.keep_classes.isdisjoint(classes) and self.keep_attrs.isdisjoint(attrs))

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)
        if tag in VOID:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        self._pop()

    def _start(self, tag, attrs):
        self._end_text()
        self.last_id += 1
        attrs = {k: v or "" for k, v in attrs} if attrs else {}
        classes = re.findall(r"\S+", attrs["class"]) if "class" in attrs else []
        row = self._add(tag, classes, attrs) if self._wanted(tag, classes, attrs) else None
        self.open.append((tag, self.last_id, row))
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        self.hidden += tag in HIDDEN
        self.preformatted += tag in PREFORMATTED

    def _add(self, tag, classes, attrs):
        nodes, row = self.nodes, len(self.nodes["tag"])
        has_text = self.text_tags is None or tag in self.text_tags
        kept = [(k, v) for k, v in attrs.items() if self.keep_tags is None or k in self.keep_attrs]
        nodes["node_id"].append(self.last_id)
        nodes["parent_id"].append(self.open[-1][1] if self.open else -1)
        nodes["pos"].append(row - self.first_node)
        nodes["tag"].append(tag)
        nodes["classes"].append(classes)
        nodes["attrs"].append(kept)
        nodes["text_from"].append(len(self.texts) - self.first_text if has_text else None)
        for known_at_the_end in ("last_desc_id", "n_inner", "text_count"):
            nodes[known_at_the_end].append(None)
        self.listeners += has_text
        return row

    def handle_endtag(self, tag):
        self._end_text()
        if tag in VOID or not self.open_names.get(tag):
            return
        while self._pop() != tag:
            pass

    def _pop(self):
        tag, _, row = self.open.pop()
        self.open_names[tag] -= 1
        self.hidden -= tag in HIDDEN
        self.preformatted -= tag in PREFORMATTED
        if row is not None:
            nodes = self.nodes
            nodes["last_desc_id"][row] = self.last_id
            nodes["n_inner"][row] = len(nodes["tag"]) - row - 1
            if self.text_tags is None or tag in self.text_tags:
                nodes["text_count"][row] = len(self.texts) - self.first_text - nodes["text_from"][row]
                self.listeners -= 1
        return tag

    def handle_data(self, data):
        if self.listeners and not self.hidden:
            self.data.append(data)

    def handle_entityref(self, name):
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        try:
            # numbers 128-159 are commonly meant as windows-1252
            text = bytes([code]).decode("windows-1252") if code < 256 else chr(code)
        except UnicodeDecodeError:
            text = chr(code)
        except (ValueError, OverflowError):
            text = "\N{REPLACEMENT CHARACTER}"
        self.handle_data(text)

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA[") :])
            self._end_text()


def batch_tokenizer(keep_tags, keep_classes, keep_attrs, text_tags, max_chars):
    """An Arrow-batch function that replaces ``html`` by ``nodes``, ``texts`` and ``parse_error``."""

    def emit(batch, first, pages):
        part = batch.slice(first, len(pages.errors)).drop_columns(["html"])
        made = pages.arrays()
        return pa.RecordBatch.from_arrays([*part.columns, *made.values()], names=[*part.schema.names, *made])

    def run(batches):
        tokenizer = PageTokenizer(keep_tags, keep_classes, keep_attrs, text_tags)
        for batch in batches:
            pages, first, chars = Pages(), 0, 0
            for html in batch.column("html"):
                html = html.as_py()
                if html is None:
                    pages.end_page("no page source")
                    continue
                try:
                    tokenizer.read(html, pages)
                    pages.end_page()
                except Exception as error:  # one bad page must not end the job
                    pages.end_page(f"{type(error).__name__}: {error}")
                chars += len(html)
                if chars > max_chars:
                    yield emit(batch, first, pages)
                    first, pages, chars = first + len(pages.errors), Pages(), 0
            if pages.errors:
                yield emit(batch, first, pages)

    return run
