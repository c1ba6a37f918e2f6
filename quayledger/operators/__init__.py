"""DataFrame-level building blocks shared by the billing plans."""
