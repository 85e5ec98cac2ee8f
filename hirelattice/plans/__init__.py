"""Composite work: check catalogues, audits, validation runs and the report bindings."""
