"""Files and tables that the steps read and write."""
