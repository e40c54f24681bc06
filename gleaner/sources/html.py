"""HTML extraction over columns of pages: the standard parser inside Arrow UDFs, one small helper for each shape."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SILENT = {"script", "style", "svg", "noscript", "head"}
_BLOCKS = {"p", "div", "br", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "section", "article", "table"}


class _Reader(HTMLParser):
    """Text with line breaks at blocks, bullets at list items; links and JSON-LD on the side."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines, self.links, self.data = [""], [], []
        self.silent, self.ordered, self.script = 0, [], None

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == "script" and at.get("type") == "application/ld+json":
            self.script = ""
        if tag in _SILENT:
            self.silent += 1
        elif tag in ("ul", "ol"):
            self.ordered.append([tag == "ol", 0])
        elif tag == "li":
            mark = "• "
            if self.ordered and self.ordered[-1][0]:
                self.ordered[-1][1] += 1
                mark = f"{self.ordered[-1][1]}. "
            self.lines.append(mark)
        elif tag == "a" and at.get("href"):
            self.links.append(at["href"])
        if tag in _BLOCKS:
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag in _SILENT and self.silent:
            self.silent -= 1
        if tag in ("ul", "ol") and self.ordered:
            self.ordered.pop()
        if tag == "script" and self.script is not None:
            self.data.append(self.script)
            self.script = None
        if tag in _BLOCKS or tag == "li":
            self.lines.append("")

    def handle_data(self, data):
        if self.script is not None:
            self.script += data
        elif not self.silent:
            self.lines[-1] += data


def _read(html: str | None) -> _Reader:
    reader = _Reader()
    if html:
        reader.feed(html)
        reader.close()
    return reader


def plain_text(html: str | None) -> str | None:
    lines = [re.sub(r"\s+", " ", x).strip() for x in _read(html).lines]
    return "\n".join(x for x in lines if x and x not in ("•",)) or None


def embedded_data(html: str | None) -> list[str]:
    """JSON-LD objects of a page, with lists and @graph flattened; broken blocks are skipped."""
    out: list[str] = []

    def collect(node) -> None:
        if isinstance(node, list):
            for x in node:
                collect(x)
        elif isinstance(node, dict):
            if isinstance(node.get("@graph"), list):
                collect(node["@graph"])
            else:
                out.append(json.dumps(node, ensure_ascii=False, sort_keys=True))

    for block in _read(html).data:
        try:
            collect(json.loads(block))
        except ValueError:
            continue
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def links(html: pd.Series) -> pd.Series:
    return html.map(lambda x: _read(x).links)


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_ld(html: pd.Series) -> pd.Series:
    return html.map(embedded_data)


#: Fields of a payload that may hold HTML.
HTML_FIELDS = (
    "job_description", "your_skills_and_experience", "why_youll_love_working_here", "top_reasons_to_join", "education_requirements_structured",
    "responsibilities_original", "responsibilities", "descriptions", "description", "requirements_original", "requirements",
    "benefits_original", "benefits", "experience", "working_model", "job_types_str",
)
#: The key of an object that holds its text, the first that is there.
TEXT_KEYS = ("value", "text", "description", "content")


class _Nodes(HTMLParser):
    """Text nodes, one line each, outside of silent elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found, self.silent = [], 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in _UNREAD

    def handle_endtag(self, tag):
        self.silent -= bool(self.silent and tag in _UNREAD)

    def handle_data(self, data):
        if not self.silent:
            self.found.append(data)


_UNREAD = {"script", "style", "svg", "noscript"}


def node_lines(value) -> str | None:
    """The lines of a field: text nodes of a string, of all members of a list, of the text of an object."""
    if isinstance(value, list):
        return "\n".join(filter(None, map(node_lines, value))) or None
    if isinstance(value, dict):
        held = [k for k in TEXT_KEYS if k in value]
        return node_lines(value[held[0]]) if held else None
    if value is None:
        return None
    text = str(value)
    if "<" in text or "&" in text:
        nodes = _Nodes()
        nodes.feed(text)
        nodes.close()
        text = "\n".join(nodes.found)
    lines = (re.sub(r"\s+", " ", x).strip() for x in text.splitlines())
    return "\n".join(x for x in lines if x) or None


def _section_text(section) -> str | None:
    if not isinstance(section, dict):
        return None
    body = node_lines(section.get("text") or section.get("html"))
    heading = re.sub(r"\s+", " ", str(section.get("heading") or "")).strip()
    return "\n".join(filter(None, (heading, body))) if body else None


def readable(json_text: str | None) -> dict[str, str]:
    """Readable text by field of a payload, and of its sections."""
    try:
        payload = json.loads(json_text) if json_text else None
    except ValueError:
        payload = None
    if not isinstance(payload, dict):
        return {}
    found = {f: node_lines(payload[f]) for f in HTML_FIELDS if payload.get(f) not in (None, "", [], {}, 0, False)}
    sections = payload.get("sections")
    found["sections"] = "\n\n".join(filter(None, map(_section_text, sections))) if isinstance(sections, list) else None
    return {k: v for k, v in found.items() if v}


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def readable_fields(payload: pd.Series) -> pd.Series:
    return payload.map(readable)
