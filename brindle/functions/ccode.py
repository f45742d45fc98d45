"""Finding functions and declarations in the text of one C file."""

from __future__ import annotations

import re

# Words that cannot name a function or variable, and those that cannot be its type.
CONTROL_WORDS = (
    "break", "case", "continue", "default", "do", "else", "for", "goto", "if", "return", "sizeof", "switch",
    "typedef", "while",
)
TYPE_WORDS = (
    "auto", "char", "const", "double", "enum", "extern", "float", "inline", "int", "long", "register", "restrict",
    "short", "signed", "static", "struct", "union", "unsigned", "void", "volatile",
)

_HEADER = re.compile(r"\b([A-Za-z_]\w*)(?:\s*\*+\s*|\s+)([A-Za-z_]\w*)\s*\(([^)]*)\)\s*\{", re.ASCII)
_BRACE = re.compile(r"[{}]")


def _closing_braces(code: str) -> dict[int, int]:
    """Position of the closing brace for every opening one, in one pass."""
    partner, unclosed = {}, []
    for brace in _BRACE.finditer(code):
        if brace[0] == "{":
            unclosed.append(brace.start())
        elif unclosed:
            partner[unclosed.pop()] = brace.start()
    return partner


def find_functions(code: str) -> list[dict]:
    """``name, params, body, pos`` of every function; of equal names the last one counts.

    ``code`` is free of comments. A body that is never closed runs to the end of the file.
    """
    partner = _closing_braces(code)
    found = {}
    for header in _HEADER.finditer(code):
        kind, name, params = header.groups()
        if kind in CONTROL_WORDS or name in CONTROL_WORDS or name in TYPE_WORDS:
            continue
        body = code[header.end() : partner.get(header.end() - 1, len(code))]
        found[name] = {"name": name, "params": params, "body": body, "pos": header.start()}
    return list(found.values())


_NAME = r"[A-Za-z_]\w*"
# `type name`, possibly with pointer stars, in front of what may follow a declared name. A
# declaration starts a statement, or a `for` header.
_DECLARATION = re.compile(rf"(?:^|[;{{}}]|\((?=[^,();]*=))\s*(?:[A-Za-z_][\w\s]*?\s)??({_NAME})(\s*\*[\s*]*|\s+)({_NAME})\s*(?=[;,\[{{]|=(?!=))", re.ASCII)
_FURTHER = re.compile(rf"\s*([\s*]*)({_NAME})", re.ASCII)
_NESTING = re.compile(r"[(){}\[\];,]")


def find_declarations(body: str) -> list[dict]:
    """``type, is_pointer, name`` of every declarator of every declaration, in their order.

    All declarators of a list share the type; each has its own stars. Commas inside brackets of any
    kind do not divide a list.
    """
    found = []
    for head in _DECLARATION.finditer(body):
        kind = head[1]
        if kind in CONTROL_WORDS:
            continue
        names, depth = [(head[2], head[3])], 0
        for sign in _NESTING.finditer(body, head.end()):
            if sign[0] in "({[":
                depth += 1
            elif sign[0] in ")}]":
                depth -= 1
            elif depth == 0 and sign[0] == ",":
                further = _FURTHER.match(body, sign.end())
                if further:
                    names.append(further.groups())
            if depth < 0 or depth == 0 and sign[0] == ";":
                break
        found += [{"type": kind, "is_pointer": "*" in stars, "name": name} for stars, name in names if name not in CONTROL_WORDS and name not in TYPE_WORDS]
    return found
