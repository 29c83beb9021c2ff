"""Wiki markup to reading text: templates by a small table, links to what they show, marks of style removed."""

from __future__ import annotations

import html
import re

# Templates that show one of their arguments, and marks that a text must have to be worked on.
SHOW_FIRST = ("bt-bellat", "bt-latbel")
SHOW_SECOND = ("нп3", "нп", "нп5", "нпг", "нп-арт")
MARKS = ("{{", "[[", "''", "==", "<ref")
#: Elements whose content is not part of the reading text.
HIDDEN = ("ref", "gallery", "math", "chem", "ce", "score", "timeline", "hiero", "graph", "imagemap", "inputbox", "categorytree", "syntaxhighlight", "source", "templatestyles")

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_HIDDEN = re.compile(r"<(" + "|".join(HIDDEN) + r")\b[^<>]*?(?:/>|>.*?</\1\s*>)", re.DOTALL | re.IGNORECASE)
_TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>")
_HEADING = re.compile(r"^(={1,6})[ \t]*(.+?)[ \t]*\1[ \t]*$", re.MULTILINE)
_EXTERNAL = re.compile(r"\[((?:https?|ftp):)?//[^\s\[\]<>]+(?:[ \t]+([^\[\]]*))?\]")
_STYLE = re.compile(r"'{2,}")
_SPACE = re.compile(r"\s+")
_EDGE = re.compile(r"\{\{|\}\}")


def _templates(text: str) -> list[tuple[int, int]]:
    """Spans of the outermost templates; braces without a partner are text."""
    out, open_ = [], []
    for m in _EDGE.finditer(text):
        if m[0] == "{{":
            open_.append(m.start())
        elif open_:
            start = open_.pop()
            while out and out[-1][0] > start:
                out.pop()
            out.append((start, m.end()))
    return out


def _arguments(body: str) -> list[str]:
    """The parts between bars that are in no inner template or link."""
    parts, depth, start, i = [], 0, 0, 0
    while i < len(body):
        two = body[i : i + 2]
        if two in ("{{", "[["):
            depth += 1
            i += 2
        elif two in ("}}", "]]"):
            depth -= 1
            i += 2
        else:
            if body[i] == "|" and depth <= 0:
                parts.append(body[start:i])
                start = i + 1
            i += 1
    return [*parts, body[start:]]


def _named(part: str) -> bool:
    """Whether an argument is key=value, the sign being outside of inner templates and links."""
    outside = re.sub(r"\{\{.*?\}\}|\[\[.*?\]\]|<[^<>]*>", "", part, flags=re.DOTALL)
    return "=" in outside


def show_template(source: str) -> str:
    """What a template {{name|...}} leaves in the text."""
    name, *rest = _arguments(source[2:-2])
    name = name.strip().lower()
    args = [a.strip() for a in rest if not _named(a)]
    first, second = [*args, "", ""][:2]
    if name in SHOW_FIRST:
        if not first:
            return second
        return first.split("{{!}}", 1)[1].strip() if "{{!}}" in first else first
    if name in SHOW_SECOND:
        return second or first
    if name == "lang" or name.startswith("lang-"):
        return args[-1] if args else ""
    return "|" if name == "!" else ""


def _replace(text: str, spans: list[tuple[int, int]], new) -> str:
    out, at = [], 0
    for a, b in spans:
        out += [text[at:a], new(text[a:b])]
        at = b
    return "".join([*out, text[at:]])


def _links(text: str) -> str:
    """[[target|shown]] -> shown, [[target]] -> target, from the innermost out."""
    while True:
        new = re.sub(r"\[\[([^\[\]]*)\]\]", lambda m: m[1].split("|", 1)[-1], text)
        if new == text:
            return text
        text = new


def clean(text: str) -> str:
    """The reading text; a text without any mark stays as it is, any other has its white space squeezed."""
    if not any(m in text for m in MARKS):
        return text
    text = _COMMENT.sub("", text)
    text = _replace(text, _templates(text), show_template)
    # templates inside of what was shown are gone
    text = _replace(text, _templates(text), lambda _: "")
    text = _HIDDEN.sub("", text)
    text = _links(text)
    text = _EXTERNAL.sub(lambda m: m[2] or "", text)
    text = _HEADING.sub(r"\2", text)
    text = _STYLE.sub("", text)
    text = _TAG.sub("", text)
    return _SPACE.sub(" ", html.unescape(text)).strip()
