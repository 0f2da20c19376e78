"""A reader for the part of HOCON that configurations use.

Objects, lists, ``=`` ``:`` ``+=``, comments, dotted and quoted keys, quoted, triple-quoted and unquoted strings,
concatenation, ``${X}`` and ``${?X}`` (a path in the file, else an environment variable), and merging of objects.
"""

from __future__ import annotations

import os
import re
from typing import Any

from ..errors import ConfigError


class _Ref:
    def __init__(self, path: str, optional: bool):
        self.path, self.optional = path, optional


class _Join:
    def __init__(self, parts: list):
        self.parts = parts


_UNQUOTED = re.compile(r"[^\s\"{}\[\],=:+#`^?!@*&\\$/]|/(?!/)|:(?=//)|[+?!@*&^`](?=[\w./:])")


class _Reader:
    def __init__(self, text: str, name: str):
        self.s, self.i, self.name = text, 0, name

    def fail(self, what: str) -> ConfigError:
        return ConfigError(f"{self.name}, line {self.s.count(chr(10), 0, self.i) + 1}: {what}")

    def space(self, newlines: bool = True) -> None:
        while self.i < len(self.s):
            c = self.s[self.i]
            if c == "#" or self.s.startswith("//", self.i):
                while self.i < len(self.s) and self.s[self.i] != "\n":
                    self.i += 1
            elif c == "\n" and not newlines or not (c.isspace() or c == "﻿"):
                return
            else:
                self.i += 1

    def peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def root(self) -> dict:
        self.space()
        if self.peek() == "{":
            self.i += 1
            out = self.members("}")
        else:
            out = self.members("")
        self.space()
        if self.i < len(self.s):
            raise self.fail(f"unexpected {self.peek()!r}")
        return out

    def members(self, end: str) -> dict:
        out: dict[str, Any] = {}
        while True:
            self.space()
            while self.peek() == ",":
                self.i += 1
                self.space()
            if self.peek() == end:
                self.i += bool(end)
                return out
            if not self.peek():
                raise self.fail("a closing brace is missing")
            path = self.key()
            self.space()
            if self.peek() == "{":
                value = self.value()
            elif self.s.startswith("+=", self.i):
                self.i += 2
                self.space(False)
                value = [self.value()]
                node = out
                for k in path[:-1]:
                    node = node.get(k, {}) if isinstance(node, dict) else {}
                if isinstance(node, dict) and isinstance(node.get(path[-1]), list):
                    value = node[path[-1]] + value
            elif self.peek() in "=:":
                self.i += 1
                self.space(False)
                value = self.value()
            else:
                raise self.fail("expected = or : or { after a key")
            put(out, path, value)
            self.space(False)
            if self.peek() not in ("\n", ",", end, ""):
                raise self.fail(f"unexpected {self.peek()!r} after a value")

    def key(self) -> list[str]:
        parts: list[str] = []
        word = ""
        quoted = False
        while True:
            c = self.peek()
            if c == '"':
                word += self.string()
                quoted = True
            elif c == ".":
                parts.append(word)
                word, quoted = "", False
                self.i += 1
            elif c and (c.isalnum() or c in "-_$*/"):
                word += c
                self.i += 1
            else:
                break
        if not word and not quoted or "" in parts:
            raise self.fail(f"expected a key, found {self.peek()!r}")
        return [*parts, word]

    def string(self) -> str:
        if self.s.startswith('"""', self.i):
            end = self.s.find('"""', self.i + 3)
            if end < 0:
                raise self.fail("a string isn't closed")
            while self.s.startswith('"', end + 3):
                end += 1
            out, self.i = self.s[self.i + 3 : end], end + 3
            return out
        out, self.i = [], self.i + 1
        while self.peek() != '"':
            c = self.peek()
            if not c or c == "\n":
                raise self.fail("a string isn't closed")
            if c == "\\":
                self.i += 1
                c = self.peek()
                if c == "u":
                    c = chr(int(self.s[self.i + 1 : self.i + 5], 16))
                    self.i += 4
                else:
                    c = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}.get(c, c)
            out.append(c)
            self.i += 1
        self.i += 1
        return "".join(out)

    def value(self) -> Any:
        parts: list[Any] = []
        gap = ""
        while True:
            c = self.peek()
            if c == "{":
                self.i += 1
                part: Any = self.members("}")
            elif c == "[":
                self.i += 1
                part = self.items()
            elif c == '"':
                part = (self.string(),)
            elif self.s.startswith("${", self.i):
                end = self.s.find("}", self.i)
                if end < 0:
                    raise self.fail("a substitution isn't closed")
                inner = self.s[self.i + 2 : end].strip()
                part, self.i = _Ref(inner.lstrip("?").strip(), inner.startswith("?")), end + 1
            else:
                m, start = _UNQUOTED.match(self.s, self.i), self.i
                while m:
                    self.i = m.end()
                    m = _UNQUOTED.match(self.s, self.i)
                if self.i == start:
                    break
                part = self.s[start : self.i]
            if parts and gap and not isinstance(part, (dict, list)):
                parts.append((gap,))
            parts.append(part)
            start = self.i
            self.space(False)
            gap = self.s[start : self.i] if not re.search("#|//", self.s[start : self.i]) else ""
            if self.peek() in "\n,}]" or not self.peek():
                break
        if not parts:
            raise self.fail("a value is missing")
        if len(parts) == 1:
            part = parts[0]
            return part[0] if isinstance(part, tuple) else scalar(part) if isinstance(part, str) else part
        if all(isinstance(p, dict) for p in parts):
            out: dict = {}
            for p in parts:
                merge(out, p)
            return out
        return _Join(parts)

    def items(self) -> list:
        out: list[Any] = []
        while True:
            self.space()
            while self.peek() == ",":
                self.i += 1
                self.space()
            if self.peek() == "]":
                self.i += 1
                return out
            if not self.peek():
                raise self.fail("a list isn't closed")
            out.append(self.value())


def scalar(word: str) -> Any:
    if word in ("true", "false"):
        return word == "true"
    if word == "null":
        return None
    if re.fullmatch(r"[+-]?\d+", word):
        return int(word)
    if re.fullmatch(r"[+-]?\d+\.\d+(?:[eE][+-]?\d+)?", word):
        return float(word)
    return word


def merge(into: dict, more: dict) -> None:
    for k, v in more.items():
        if isinstance(v, dict) and isinstance(into.get(k), dict):
            merge(into[k], v)
        else:
            into[k] = v


def put(into: dict, path: list[str], value: Any) -> None:
    for k in path[:-1]:
        if not isinstance(into.get(k), dict):
            into[k] = {}
        into = into[k]
    if isinstance(value, dict) and isinstance(into.get(path[-1]), dict):
        merge(into[path[-1]], value)
    else:
        if isinstance(value, _Ref) and value.optional and path[-1] in into:
            value = _Join([_Fallback(into[path[-1]], value)])
        into[path[-1]] = value


class _Fallback:
    """A value that an optional substitution replaces if it is set."""

    def __init__(self, old: Any, ref: _Ref):
        self.old, self.ref = old, ref


_ABSENT = object()


def parse(text: str, name: str = "config", env: dict[str, str] | None = None) -> dict:
    env = dict(os.environ) if env is None else env
    root = _Reader(text, name).root()

    def look(path: str) -> Any:
        node: Any = root
        for k in path.split("."):
            node = node.get(k.strip('"'), _ABSENT) if isinstance(node, dict) else _ABSENT
            if node is _ABSENT:
                return env.get(path, _ABSENT)
        return node

    def resolve(value: Any, seen: tuple[str, ...] = ()) -> Any:
        if isinstance(value, dict):
            out = {k: resolve(v, seen) for k, v in value.items()}
            return {k: v for k, v in out.items() if v is not _ABSENT}
        if isinstance(value, list):
            return [x for x in (resolve(v, seen) for v in value) if x is not _ABSENT]
        if isinstance(value, _Fallback):
            found = resolve(value.ref, seen)
            return resolve(value.old, seen) if found is _ABSENT else found
        if isinstance(value, _Ref):
            if value.path in seen:
                raise ConfigError(f"{name}: ${{{value.path}}} refers to itself")
            found = look(value.path)
            if found is _ABSENT:
                if value.optional:
                    return _ABSENT
                raise ConfigError(f"{name}: ${{{value.path}}} is neither in the file nor an environment variable")
            return resolve(found, (*seen, value.path))
        if isinstance(value, _Join):
            parts = [resolve(p[0] if isinstance(p, tuple) else p, seen) for p in value.parts]
            there = [p for p in parts if p is not _ABSENT]
            if there and all(isinstance(p, dict) for p in there):
                out = {}
                for p in there:
                    merge(out, p)
                return out
            if len(there) == 1 and len(parts) == 1:
                return there[0]
            if there and all(isinstance(p, list) for p in there):
                return [x for p in there for x in p]
            return "".join(str(p).lower() if isinstance(p, bool) else str(p) for p in there)
        return value

    return resolve(root)
