"""Column expressions. Nothing here touches a DataFrame or runs a job."""
