"""Query plans: the registered queries, their SQL oracle, the end-to-end
common-flight build and the report-message staging job."""
