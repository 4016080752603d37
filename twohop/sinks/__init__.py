from twohop.sinks.report import report_lines, write_report

__all__ = ["report_lines", "write_report"]
