"""Landing, merge, classification, review and reporting operators."""
