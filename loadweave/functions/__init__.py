"""Column functions. All are plain expressions, so they stay inside generated code and reach the scan where they can."""
