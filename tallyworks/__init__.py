"""Tallyworks: data jobs and DataFrame operators for Spark."""

from tallyworks.session import build_session, cut_lineage, new_folder, shared_folder

__all__ = ["build_session", "cut_lineage", "new_folder", "shared_folder"]
