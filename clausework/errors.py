"""Errors with a stable code, a message made from a template, and a hint."""

from __future__ import annotations

import json

#: Code to (template, hint).
CATALOGUE = {
    "LLM-E001": ("the model did not answer within {timeout} s", "raise the timeout or shorten the chunks"),
    "LLM-E002": ("the model answered with status {status}", "a status of 429 or from 500 on passes; others need a change of the request"),
    "LLM-E003": ("the model cannot be reached: {reason}", "see that the provider runs"),
    "LLM-E004": ("the model's answer has an unexpected shape", "see what the provider returns"),
}


class EngineError(RuntimeError):
    def __init__(self, code: str, **context):
        template, hint = CATALOGUE[code]
        self.code, self.context, self.hint = code, context, hint

        class Named(dict):
            def __missing__(self, key):
                return "{" + key + "}"

        super().__init__(f"{code}: {template.format_map(Named(context))} ({hint})")

    def __reduce__(self):
        return _again, (self.code, self.context)

    def transient(self) -> bool:
        """Whether another try may help: unreachable, status 429, or from 500 on."""
        status = self.context.get("status")
        return self.code == "LLM-E003" or (self.code == "LLM-E002" and isinstance(status, int) and (status == 429 or status >= 500))

    def packed(self) -> str:
        """The error as text that ``unpacked`` reads."""
        return json.dumps({"code": self.code, "context": self.context}, default=str)


def _again(code: str, context: dict) -> EngineError:
    return EngineError(code, **context)


def packed(error: Exception) -> str:
    """Any error as text, to be carried in a row."""
    return error.packed() if isinstance(error, EngineError) else json.dumps({"message": f"{type(error).__name__}: {error}"})


def unpacked(text: str) -> Exception:
    """The error that ``packed`` wrote: an EngineError, or a RuntimeError with the other's name and message."""
    said = json.loads(text)
    return EngineError(said["code"], **said["context"]) if "code" in said else RuntimeError(said["message"])
