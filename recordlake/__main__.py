from recordlake.cli import main

main()
