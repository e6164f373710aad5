"""The query set run on the driver's tables, with the SQL each must agree with."""
