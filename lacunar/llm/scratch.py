"""Intermediate tables of this subpackage lie where those of the rest do."""

from lacunar.sources.scratch import delete, materialize, new_path, release, shared_dir

__all__ = ["delete", "materialize", "new_path", "release", "shared_dir"]
