"""XML trees in Python workers: safe parsing, local names, text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree as ET

_DECLARATION = re.compile(r"^\s*<\?xml[^>]*\?>")
_DOCTYPE = re.compile(r"<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>", re.S)
_NAMESPACE = re.compile(r"xmlns(?::([^\s=]+))?")
HREF = "{http://www.w3.org/1999/xlink}href"


def parse(source: str | bytes | None) -> ET.Element | None:
    """The root with local tag names, or null if the text is not well-formed. A DOCTYPE is dropped, so no entity is ever expanded."""
    if source is None:
        return None
    text = bytes(source).decode("utf-8-sig", "replace") if isinstance(source, (bytes, bytearray, memoryview)) else source.lstrip("﻿")
    text = _DOCTYPE.sub("", text) if "<!DOCTYPE" in text else text
    text = _DECLARATION.sub("", text) if "<?xml" in text else text
    try:
        root = ET.fromstring(text)
    except (ET.ParseError, ValueError):
        return None
    # A name has a namespace only by a default one or by a prefix, which then stands before it in the text.
    if "xmlns" in text and any(not p or f"<{p}:" in text for p in {"xml", *_NAMESPACE.findall(text)}):
        for e in root.iter():
            if e.tag[0] == "{":
                e.tag = e.tag.rpartition("}")[2]
    return root


def below(e: ET.Element, *path: str) -> list[ET.Element]:
    """Children of children along local names."""
    found = e.findall(path[0])
    for name in path[1:]:
        found = [c for p in found for c in p.findall(name)]
    return found


def inside(e: ET.Element, *names: str) -> Iterator[ET.Element]:
    """Descendants with one of the names, in document order."""
    return (c for c in (e.iter(*names) if len(names) == 1 else e.iter()) if c is not e and c.tag in names)


def squash(text: str) -> str:
    return " ".join(text.split())


def spaced(e: ET.Element | None) -> str:
    """All text with a space at every tag, collapsed."""
    return "" if e is None else squash(" ".join(e.itertext()) if len(e) else e.text or "")


def trimmed(e: ET.Element) -> str:
    """All non-blank pieces of text, each stripped, joined by a space."""
    return " ".join(filter(None, map(str.strip, e.itertext()))) if len(e) else (e.text or "").strip()


def first(found: list[ET.Element]) -> ET.Element | None:
    return found[0] if found else None
