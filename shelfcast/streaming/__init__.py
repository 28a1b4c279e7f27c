"""Reading only what is new."""
