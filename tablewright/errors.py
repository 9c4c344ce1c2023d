"""Errors that name the place in a plan where they arose."""


class ConfigError(ValueError):
    """A plan's description is wrong."""


class PlanBuilderError(RuntimeError):
    """A stage or column can't be compiled."""

    def __init__(self, stage: str, column: str | None, detail: str):
        self.stage, self.column, self.detail = stage, column, detail
        super().__init__(f"stage {stage!r}" + (f", column {column!r}" if column else "") + f": {detail}")


class WriterError(RuntimeError):
    """A target can't be written."""

    def __init__(self, target: str, mode: str, detail: str):
        self.target, self.mode, self.detail = target, mode, detail
        super().__init__(f"{mode} into {target!r}: {detail}")
