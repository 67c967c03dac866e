"""Requests to a chat model, and a provider that makes them.

Templates name their values as ``<<KEY>>``, since they may hold braces; a key without a value is an
error. ``Chat`` turns a function (system text, user text, JSON schema) -> record into a provider.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

from tessera.params import DEFAULTS, Params
from tessera.replies import json_schema

_RULES = """Keep every fact of the source and add none: no links, numbers or names that it does not have.
Copy marks such as [ссылка-1] letter for letter. Write in the language of the source."""

TEMPLATES = {
    "filter": """You sort support tickets for a knowledge base on <<DOMAIN>>. For one question and its answer decide:
reusable_question: another user could ask the same; general_answer: the answer is a rule or an instruction for anyone;
complete_answer: it is enough to solve the matter; no_private_data: its core names no person and no account.
topic: the subject in a few words.""",
    "rewrite": """You write entries of a knowledge base on <<DOMAIN>> from support tickets.
Question: about <<QUESTION_WORDS>> words. Answer: about <<ANSWER_WORDS>> words, steps in order.
""" + _RULES + "\nCategories:\n<<CATEGORIES>>",
    "repair": """You mend entries of a knowledge base on <<DOMAIN>>. Correct spelling, cut-off sentences and missing questions.
If the answer has no substance, complete is false, both texts are empty and reason says why in ten words at most.
""" + _RULES + "\nCategories:\n<<CATEGORIES>>",
    "judge": """You compare two entries of a knowledge base on <<DOMAIN>>. duplicate: both answer one question.
relation: same (the answers agree), alternatives (both may be right, for different causes), contradiction (only one can be).""",
    "match": """You compare a new entry with one of a knowledge base on <<DOMAIN>>. duplicate: both answer one question.
relation: same (the answers agree), alternatives (both may be right, for different causes), contradiction (the new one replaces the old).""",
    "merge": """You join entries of a knowledge base on <<DOMAIN>> that answer one question into one, with all details of each.
Answer: about <<ANSWER_WORDS>> words.
""" + _RULES + "\nCategories:\n<<CATEGORIES>>",
    "variants": """You join entries of a knowledge base on <<DOMAIN>> that answer one question for different causes.
Number the causes; under each give its whole answer. Answer: about <<ANSWER_WORDS>> words.
""" + _RULES + "\nCategories:\n<<CATEGORIES>>",
}


def render(template: str, **values: Any) -> str:
    """The template with its values, each key once looked up."""
    return re.sub("<<([A-Z_]+)>>", lambda m: str(values[m[1].lower()]), template)


def bullets(categories: dict[str, str]) -> str:
    return "\n".join(f"- {name} — {about}" for name, about in categories.items())


def one(entry: dict) -> str:
    return f"Question: {entry['question'] or ''}\nAnswer: {entry['answer'] or ''}"


def numbered(entries: list[dict]) -> str:
    return "\n\n".join(f"Entry {n}.\n{one(e)}" for n, e in enumerate(entries, 1))


def short(a: dict, b: dict, longest: int = 60) -> str:
    """Two questions on one line, for a log."""
    return " / ".join((e["question"] or "")[:longest] for e in (a, b))


class Chat:
    """A provider over a chat model."""

    def __init__(self, complete: Callable[[str, str, dict], dict | None], domain: str, categories: dict[str, str], embedder: Callable[[list[str]], list[list[float]]] | None = None, params: Params = DEFAULTS):
        self.complete, self.domain, self.categories, self.embedder, self.params = complete, domain, categories, embedder, params

    def _ask(self, method: str, user: str, template: str | None = None, answer_words: int | None = None) -> dict | None:
        system = render(
            TEMPLATES[template or method], domain=self.domain, categories=bullets(self.categories),
            question_words=self.params.question_target_words, answer_words=answer_words or self.params.answer_target_words,
        )
        return self.complete(system, user, json_schema(method, list(self.categories)))

    def filter(self, pair: dict) -> dict | None:
        return self._ask("filter", one(pair))

    def rewrite(self, pair: dict, hint: str) -> dict | None:
        return self._ask("rewrite", one(pair) + hint)

    def repair(self, pair: dict, hint: str) -> dict | None:
        return self._ask("repair", one(pair) + hint)

    def judge(self, a: dict, b: dict) -> dict | None:
        return self._ask("judge", numbered([a, b]))

    def match(self, new: dict, base: dict) -> dict | None:
        return self._ask("match", f"New.\n{one(new)}\n\nKnown.\n{one(base)}")

    def merge(self, entries: list[dict], variants: bool, hint: str = "") -> dict | None:
        words = self.params.variants_target_words if variants else None
        return self._ask("merge", numbered(entries) + hint, "variants" if variants else "merge", words)

    def embed(self, texts: list[str]) -> list[list[float]]:
        if self.embedder is None:
            raise ValueError("no embedding model")
        return self.embedder(texts)

    def health(self) -> dict[str, str]:
        """One sample call for each role."""
        pair = {"question": "?", "answer": "."}
        calls = {"filter": lambda: self.filter(pair), "judge": lambda: self.judge(pair, pair), "embed": lambda: self.embed(["?"])}
        out = {}
        for role, call in calls.items():
            try:
                out[role] = "ok" if call() is not None else "no reply"
            except Exception as e:
                out[role] = f"error: {type(e).__name__}"
        return out
