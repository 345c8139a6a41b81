"""Options of a run: defaults, command line, and batch file."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

# Option name, flags, kind and default. Kinds: text, list, whole,
# number, switch (y/n).
OPTIONS = (
    ("database", ("-d",), "text", ""),
    ("gb_file", ("-g",), "text", "sequence.gb"),
    ("modules", ("-o",), "list", ""),
    ("max_seq_length", ("-m",), "whole", 10000),
    ("hmm_database", ("-M",), "text", ""),
    ("print_non_match", ("-Z",), "switch", False),
    ("individual_columns", ("-v",), "list", ""),
    ("individual_condition", ("-V",), "text", ""),
    ("inter_genes", ("-i",), "text", ""),
    ("backup", ("-b",), "list", ""),
    ("e_value_cut_off", ("-e",), "number", 1e-7),
    ("n_cut_off", ("-n",), "number", 0.1),
    ("sim_cut_off", ("-s",), "text", "all,0.99"),
    ("min_seq_length_gene", ("-l",), "whole", 50),
    ("tree_clust_type", ("-C",), "text", "both"),
    ("group_on_genera", ("-G",), "switch", True),
    ("comp_columns", ("-cc",), "list", "species"),
    ("comp_kind", ("-ck",), "list", "h"),
    ("comp_score", ("-cs",), "list", "2"),
    ("phylo_method", ("-p",), "text", "distance"),
    ("concat_phylo_method", ("-c",), "text", "distance_bootstrap_100"),
    ("stop_criterion", ("-r",), "text", "iterations_3"),
    ("max_alignment_group_size", ("-ms",), "whole", 200),
    ("use_guide_tree", ("-ug",), "switch", False),
    ("alignment_format", ("-a",), "text", "phylip"),
    ("interleaved", ("-D",), "switch", False),
    ("bases_per_row", ("-W",), "text", "1000"),
    ("partition_file", ("-A",), "switch", True),
    ("use_genes", ("-u",), "list", "all"),
    ("anchor_gene", ("-Q",), "list", ""),
    ("maximize_linking", ("-L",), "switch", False),
    ("get_taxon", ("-t",), "text", "combined"),
    ("only_show", ("-O",), "switch", False),
    ("sequence_name_column", ("-S",), "text", "taxon_name"),
    ("out_file_name", ("-N",), "text", "out"),
    ("changes_files", ("-H",), "list", ""),
    ("change_option", ("-ch",), "text", "change"),
    ("tree_file", ("-R",), "text", "combined,combined"),
    ("tree_infile", ("-I",), "switch", False),
    ("linked_genes", ("-k",), "text", ""),
    ("store_boot_trees", ("-B",), "switch", False),
    ("column_name", ("-U",), "list", ""),
    ("create_gene_trees", ("-E",), "switch", True),
    ("remove_outliers", ("-Y",), "switch", True),
    ("print_rogues", ("-w",), "switch", True),
    ("output_no_rogues_tree", ("-x",), "switch", False),
    ("rm_rogues_from_ml_tree", ("-z",), "switch", False),
    ("rm_rogues_from_alignment", ("-q",), "switch", False),
    ("rogue_file", (), "text", ""),
    ("alignment_file", (), "text", ""),
    ("b0", ("-b0",), "whole", 0),
    ("b1", ("-b1",), "whole", 0),
    ("b2", ("-b2",), "whole", 0),
    ("b3", ("-b3",), "whole", 0),
    ("b4", ("-b4",), "whole", 0),
    ("b5", ("-b5",), "text", "n"),
    ("print_batch_file", ("-X",), "switch", False),
    ("stats_type", (), "text", "alignment"),
    ("path", ("-P",), "text", ""),
    ("threads", ("-T",), "whole", 0),
)
KINDS = {name: kind for name, _, kind, _ in OPTIONS}
FLAGS = {flag: name for name, flags, _, _ in OPTIONS for flag in (*flags, f"--{name}")}
# Other spellings that are understood.
SPELLINGS = {"gene_tree": "tree_file"}
MODULE_SPELLINGS = {"catenated_tree": "concatenated_tree"}
# Left alone: Spark spreads the work, and no outside program is called.
WITHOUT_EFFECT = ("path", "threads")


def _value(kind: str, text: str):
    if kind == "list":
        return [part.strip() for part in text.split(",") if part.strip()]
    if kind == "switch":
        return text.strip().lower()[:1] != "n"
    return {"text": str, "whole": int, "number": float}[kind](text.strip())


@dataclass
class Settings:
    """Option values by name; unknown names are errors."""

    values: dict = field(default_factory=lambda: {
        name: _value(kind, default) if kind == "list" else default for name, _, kind, default in OPTIONS
    })

    def __getattr__(self, name):
        values = self.__dict__.get("values", {})
        if name in values:
            return values[name]
        raise AttributeError(name)

    def set(self, name: str, text: str) -> None:
        name = SPELLINGS.get(name, name)
        if name not in KINDS:
            raise ValueError(f"unknown option {name}")
        if name in WITHOUT_EFFECT:
            warnings.warn(f"option {name} has no effect", stacklevel=2)
        value = _value(KINDS[name], text)
        if name == "anchor_gene" and value == ["n"]:
            value = []
        if name == "modules":
            value = [MODULE_SPELLINGS.get(m, m) for m in value]
        self.values[name] = value


def read_batch(lines: Iterable[str], settings: Settings | None = None) -> Settings:
    """Settings from ``name value`` lines; # starts a comment unless written as \\#."""
    settings = settings or Settings()
    for line in lines:
        text = re.sub(r"(?<!\\)#.*", "", line).replace("\\#", "#").strip()
        if not text:
            continue
        name, _, value = text.partition(" ")
        settings.set(name.lower(), value.strip() or "all" if name.lower() == "backup" else value.strip() or "y")
    return settings


def write_batch(settings: Settings) -> str:
    """Batch-file text that reads back as the same settings."""
    def shown(kind, value):
        if kind == "list":
            return ",".join(value)
        if kind == "switch":
            return "y" if value else "n"
        return str(value)

    lines = [
        f"{name} {shown(kind, settings.values[name])}".replace("#", "\\#")
        for name, _, kind, _ in OPTIONS if name not in WITHOUT_EFFECT and shown(kind, settings.values[name])
    ]
    return "\n".join(lines) + "\n"


def read_arguments(arguments: Sequence[str]) -> Settings:
    """Settings from the command line, which overrides the batch file it names.

    A single argument is a batch file; two are a batch file and a record file.
    """
    settings, rest = Settings(), list(arguments)
    plain = [a for a in rest if not a.startswith("-")]
    if len(rest) in (1, 2) and len(plain) == len(rest):
        rest = ["-f", rest[0], *(["-g", rest[1]] if len(rest) == 2 else [])]
    pairs, at = [], 0
    while at < len(rest):
        flag, at = rest[at], at + 1
        values = []
        if at < len(rest) and (not rest[at].startswith("-") or re.fullmatch(r"-[0-9.eE-]+", rest[at])):
            values, at = [rest[at]], at + 1
        pairs.append((flag, values[0] if values else ""))
    for flag, value in pairs:
        if flag in ("-f", "--batch_file"):
            with open(value) as handle:
                read_batch(handle, settings)
    for flag, value in pairs:
        if flag in ("-f", "--batch_file"):
            continue
        if flag not in FLAGS:
            raise ValueError(f"unknown option {flag}")
        name = FLAGS[flag]
        settings.set(name, value or ("all" if name == "backup" else "y"))
    return settings


def gene_groups(linked: str, genes: Sequence[str]) -> list[list[str]]:
    """Groups of linked genes among ``genes``; a gene in no group is its own."""
    groups = [[g for g in part.split(";") if g in genes] for part in linked.split(",") if part]
    named = {g for group in groups for g in group}
    return [g for g in groups if g] + [[g] for g in genes if g not in named]


def intergenes(text: str) -> list[tuple[str, str, str]]:
    """``name,lead;trail,…`` as (gene, lead_gene, trail_gene)."""
    parts = text.split(",") if text else []
    found = []
    for name, ends in zip(parts[::2], parts[1::2]):
        if ends.count(";") != 1:
            raise ValueError(f"inter_genes must read gene,leading;trailing, not {name},{ends}")
        found.append((name, *ends.split(";")))
    if len(parts) % 2:
        raise ValueError("inter_genes must read gene,leading;trailing")
    return found


