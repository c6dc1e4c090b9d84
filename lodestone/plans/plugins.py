"""Plugins: packages of classifiers, emitters and configuration that a run takes in.

A plugin is any object with a ``name`` and some of: ``requires`` (names of plugins it needs), ``classification``
(keys of the cascade's configuration, which the run's own keys override), ``proposals(record)`` (Columns of
proposals), ``classes`` (what projection takes, projectors among them) and ``enrichment``. ``load`` finds it by
the address of a module, ``package.module`` or ``package.module:attribute``, whose ``register(registry)`` may
register several.
"""

from __future__ import annotations

import importlib
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.plan import settled
from lodestone.operators import classify
from lodestone.plans.config import ConfigError, topological


@dataclass
class Registry:
    """The plugins of a run, in the order they depend on each other."""

    plugins: dict[str, Any] = field(default_factory=dict)

    def register(self, plugin: Any) -> None:
        """Takes a plugin in; names are unique."""
        name = getattr(plugin, "name", None)
        if not name:
            raise ConfigError(f"a plugin needs a name: {plugin!r}")
        if name in self.plugins:
            raise ConfigError(f"two plugins are named {name!r}")
        self.plugins[name] = plugin

    def load(self, address: str) -> None:
        """Registers what a module offers: its ``register`` function, or the named attribute."""
        module_name, _, attribute = address.partition(":")
        try:
            module = importlib.import_module(module_name)
        except ImportError as e:
            raise ConfigError(f"no plugin at {address!r}: {e}") from e
        if attribute:
            self.register(getattr(module, attribute))
        elif hasattr(module, "register"):
            module.register(self)
        else:
            raise ConfigError(f"{address!r} has no register function")

    def ordered(self) -> list[Any]:
        """What a plugin requires comes before it; a cycle keeps the order of registration."""
        needs = {name: list(getattr(p, "requires", ())) for name, p in self.plugins.items()}
        if missing := sorted({d for ds in needs.values() for d in ds} - set(self.plugins)):
            raise ConfigError(f"plugins that others require are missing: {missing}")
        return [self.plugins[n] for n in topological(needs)]

    def merged(self, name: str, own: dict | None = None) -> dict:
        """A configuration block of all plugins, later ones over earlier ones, and ``own`` over all."""
        out: dict = {}
        for p in self.ordered():
            out |= getattr(p, name, None) or {}
        return out | (own or {})

    def classify(self, records: DataFrame, config: dict) -> DataFrame:
        """The cascade with the plugins' configuration, and their own proposals before conflicts are resolved."""
        merged = self.merged("classification", config)
        made = [c for p in self.ordered() if hasattr(p, "proposals") for c in p.proposals(F.col("rec"))]
        out = classify.cascade(records, merged)
        if not made:
            return out
        more = F.array_compact(F.array(*[m.cast(classify.PROPOSAL) for m in made]))
        out = out.drop("classification").withColumn("proposals", settled(F.concat("proposals", more)))
        return classify.resolve(out, merged.get("onConflict", "quarantine"), merged.get("evidence", True))
