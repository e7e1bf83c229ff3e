"""Training-data operators: packing, counting, scans, extraction, joins, filters, decontamination.

Nothing outside this subpackage imports it. Query registrations are in ``queries``.
"""
