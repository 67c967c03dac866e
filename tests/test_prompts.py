import pytest

from tessera import prompts as P
from tessera.providers import Retry


def test_templates():
    assert P.render("<<A>> {x} <<B_C>>", a="<<B_C>>", b_c=2) == "<<B_C>> {x} 2"
    with pytest.raises(KeyError):
        P.render("<<NOPE>>")
    assert P.bullets({"a": "first", "b": "second"}) == "- a — first\n- b — second"
    assert P.numbered([{"question": "q", "answer": None}, {"question": "r", "answer": "s"}]) == "Entry 1.\nQuestion: q\nAnswer: \n\nEntry 2.\nQuestion: r\nAnswer: s"
    assert P.short({"question": "x" * 99}, {"question": None}) == "x" * 60 + " / "


def test_chat_provider():
    asked = []

    def complete(system, user, schema):
        asked.append((system, user, schema))
        return {k: {"boolean": True, "string": "text"}[v["type"]] if "enum" not in v else v["enum"][0] for k, v in schema["properties"].items()}

    chat = P.Chat(complete, "travel", {"a": "first"})
    retry, pair = Retry(attempts=1), {"question": "q", "answer": "see {this}"}
    for method, call in {
        "filter": lambda: chat.filter(pair), "rewrite": lambda: chat.rewrite(pair, " hint"), "repair": lambda: chat.repair(pair, ""), "judge": lambda: chat.judge(pair, pair),
        "match": lambda: chat.match(pair, pair), "merge": lambda: chat.merge([pair, pair], True, " hint"),
    }.items():
        assert retry.call(method, call), method
        system, user, schema = asked[-1]
        assert "<<" not in system and "travel" in system and "see {this}" in user and schema["required"]
    assert "- a — first" in asked[1][0] and asked[1][1].endswith(" hint") and "Number the causes" in asked[5][0]
    assert chat.health() == {"filter": "ok", "judge": "ok", "embed": "error: ValueError"}
