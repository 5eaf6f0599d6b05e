"""Registered queries: each operator over the test tables, with its SQL oracle."""

from importlib import import_module

MODULES = (
    "sources", "intervals", "coverage", "qc", "copynumber", "structural", "genotype",
    "phasing", "pharmaco", "ploidy", "annotate", "assay", "samples",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"strandwise.plans.{name}")
