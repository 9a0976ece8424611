"""Deterministic stand-ins for models, for tests and examples."""

from __future__ import annotations


def counting_model():
    """Answers with the length of the last message; fails on one sentence."""

    def answer(messages: list[dict]) -> str:
        content = messages[-1]["content"]
        if "今天" in content:
            raise RuntimeError("no answer")
        return '{"chars": %d}' % len(content)

    return answer


def patient_model():
    """Answers as ``counting_model``, and on every sentence."""
    return lambda messages: '{"chars": %d}' % len(messages[-1]["content"])


def open_tagger(name: str):
    """A tagger by its name; only one of two can be opened, and it marks its tokens with its name."""
    from ..operators.syntax import whitespace_tagger

    if name != "small":
        raise OSError(f"no model {name}")
    parse = whitespace_tagger()
    return lambda text: [t | {"tag": name} for t in parse(text)]


def entity_model():
    """Answers one fenced entity object."""
    return lambda messages: '```json\n{"Location": ["x"]}\n```'


def triple_model():
    """Answers a triple list, prose, a failure or nothing, depending on the text."""

    def answer(messages: list[dict]) -> str:
        content = messages[-1]["content"]
        if "城市北部" in content:
            return '[["政府", "推进", "建设"]]'
        if "建筑设计" in content:
            return "< 政府, 推进, 建设 >"
        if "发展目标" in content:
            raise RuntimeError("no answer")
        return "[]"

    return answer
