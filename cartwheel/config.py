"""Window settings, read from a flat property map."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

ROLLING_BRANCHES = ("product", "category", "cart", "purchase")

DEFAULT_TTL_SECONDS = 900
WATERMARK_DELAY = "5 seconds"
CHECKPOINT_INTERVAL = "5 seconds"


@dataclass(frozen=True)
class RollingWindow:
    """One rolling window of a branch. ``label`` ends up in metric names."""

    label: str
    duration_seconds: int
    emit_seconds: int
    ttl_seconds: int


@dataclass(frozen=True)
class SessionWindow:
    gap_seconds: int
    emit_seconds: int
    ttl_seconds: int


@dataclass(frozen=True)
class FeatureConfig:
    session: SessionWindow
    rolling: Mapping[str, tuple[RollingWindow, ...]] = field(default_factory=dict)
    contexts: Mapping[str, str] = field(default_factory=dict)
    """Field names of the contexts of raw tracker events; without any they are found by their endings."""

    def windows(self, branch: str) -> tuple[RollingWindow, ...]:
        return self.rolling.get(branch, ())

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> FeatureConfig:
        """``metric.sizes`` is mandatory; a size without ``duration_seconds`` is skipped."""
        if "metric.sizes" not in props:
            raise ValueError("property metric.sizes is not set")
        sizes = props["metric.sizes"].split(",")

        def window(branch: str, size: str) -> RollingWindow:
            prefix = f"metric.{branch}.{size}"
            return RollingWindow(
                size,
                int(props[f"{prefix}.duration_seconds"]),
                int(props[f"{prefix}.emit_seconds"]),
                int(props[f"{prefix}.ttl_seconds"]),
            )

        rolling = {
            branch: tuple(
                window(branch, size)
                for size in sizes
                if f"metric.{branch}.{size}.duration_seconds" in props
            )
            for branch in ROLLING_BRANCHES
        }
        session = SessionWindow(
            int(props["metric.session.gap_seconds"]),
            int(props["metric.session.emit_seconds"]),
            int(props["metric.session.ttl_seconds"]),
        )
        contexts = {key.removeprefix("context."): name for key, name in props.items() if key.startswith("context.")}
        return cls(session, rolling, contexts)

    @classmethod
    def from_files(cls, *paths: str) -> FeatureConfig:
        """Later files win, as when job properties are laid over cluster properties."""
        props: dict[str, str] = {}
        for path in paths:
            with open(path, encoding="utf-8") as lines:
                for line in map(str.strip, lines):
                    if line and not line.startswith(("#", "!")) and "=" in line:
                        key, value = line.split("=", 1)
                        props[key.strip()] = value.strip()
        return cls.from_properties(props)
