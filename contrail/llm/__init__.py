"""Operators for preparing training text.  Nothing outside this subpackage
imports it; its queries are listed in ``contrail.llm.queries``."""
