"""The graph's schema registry: node and edge types with their properties, kept as JSON. It is advisory."""

from __future__ import annotations

import copy
import json
import os

#: Fixed values.
NODE_TYPES = {
    "Paper": {"arxiv_id": "STRING", "title": "STRING", "abstract": "STRING", "problem_statement": "STRING"},
    "Author": {"name": "STRING", "email": "STRING"},
    "Institution": {"name": "STRING", "country": "STRING"},
    "Dataset": {"name": "STRING", "description": "STRING"},
    "Method": {"name": "STRING", "description": "STRING"},
    "Result": {"metric_name": "STRING", "metric_value": "STRING", "conditions": "STRING"},
    "Metric": {"name": "STRING"},
}
EDGE_TYPES = {
    "AUTHORED_BY": {"order": "INTEGER"},
    "AFFILIATED_WITH": {},
    "USES_DATASET": {"role": "STRING"},
    "PROPOSES_METHOD": {},
    "BUILDS_ON": {"relation": "STRING"},
    "COMPARES_TO": {"notes": "STRING"},
    "HAS_RESULT": {},
    "ON_DATASET": {},
    "USES_METRIC": {},
}


class SchemaRegistry:
    """Types read from a JSON file if there is one, else the seed, which is then saved."""

    def __init__(self, path: str | None = None):
        self.path = path
        if path and os.path.exists(path):
            with open(path) as f:
                found = json.load(f)
            self.node_types, self.edge_types = found["node_types"], found["edge_types"]
        else:
            self.node_types = {k: list(v) for k, v in copy.deepcopy(NODE_TYPES).items()}
            self.edge_types = {k: list(v) for k, v in copy.deepcopy(EDGE_TYPES).items()}
            self.save()

    def save(self) -> None:
        if self.path:
            with open(self.path, "w") as f:
                json.dump({"node_types": self.node_types, "edge_types": self.edge_types}, f, indent=2)

    def add_node_type(self, name: str, properties: list[str]) -> None:
        self.node_types[name] = list(properties)
        self.save()

    def add_edge_type(self, name: str, properties: list[str]) -> None:
        self.edge_types[name] = list(properties)
        self.save()

    def as_prompt(self) -> str:
        part = lambda types, none: [f"  {k}: {', '.join(v) or none}" for k, v in types.items()]
        return "\n".join(["NODE TYPES:", *part(self.node_types, ""), "EDGE TYPES:", *part(self.edge_types, "no properties")])
